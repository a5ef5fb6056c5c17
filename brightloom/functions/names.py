"""Column names: renaming from lists and normalising."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def camel_to_snake(name: str) -> str:
    """``airportID`` to ``airport_id``: a run of capitals is one word."""
    out = []
    for i, ch in enumerate(name):
        before = name[i - 1] if i else ""
        after = name[i + 1] if i + 1 < len(name) else ""
        starts_word = ch.isupper() and i > 0 and (
            before.islower() or before.isdigit() or (after.islower() and before != "_")
        )
        out.append(("_" if starts_word else "") + ch.lower())
    return "".join(out)


def split_capitals(name: str) -> str:
    """``LowTemp`` to ``low_temp``, every capital starting a word."""
    return "_".join(part.lower() for part in re.findall(r"[A-Z][^A-Z]*|^[^A-Z]+", name))


def plain(name: str) -> str:
    """Trimmed, lower case, blanks to underscores."""
    return name.strip().lower().replace(" ", "_")


def rename_all(df: DataFrame, names: str) -> DataFrame:
    """Rename columns from a comma-separated list; camel case becomes snake case."""
    return df.toDF(*[camel_to_snake(n.strip()) for n in names.split(",")])


def normalise_names(df: DataFrame, rule=plain) -> DataFrame:
    return df.toDF(*[rule(c) for c in df.columns])
