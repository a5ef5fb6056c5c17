"""Quality rules: a threshold table compiled into one projection of native expressions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from brightloom.llm.common import let, words_of

# Common function words of English, French, German and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from he in is it of on or that the this to was were with "
    "au aux ce dans de des du elle en est et il la le les mais ne ou par pas pour que qui se sur un une "
    "aber auf aus das dem den der die ein eine für im ist mit nicht sich und von zu "
    "al como con del el ella es las lo los más no para por se sin su una y"
).split()

WINDOW = 5


@dataclass(frozen=True)
class Rule:
    """Bounds in percent for ``numerator / denominator``; a rule with a zero denominator holds.

    A rule says nothing about texts of fewer than ``from_words`` words.
    """

    name: str
    numerator: str
    denominator: str
    at_least: int | None = None
    at_most: int | None = None
    from_words: int = 0

    def holds(self, counts: Column) -> Column:
        """The rule over a struct of counts, in whole numbers."""
        part, whole, held = counts[self.numerator], counts[self.denominator], F.lit(True)
        if self.at_least is not None:
            held = held & (100 * part >= self.at_least * whole)
        if self.at_most is not None:
            held = held & (100 * part <= self.at_most * whole)
        return held | (counts["n_words"] < self.from_words)

    def sql(self) -> str:
        checks = []
        if self.at_least is not None:
            checks.append(f"100 * {self.numerator} >= {self.at_least} * {self.denominator}")
        if self.at_most is not None:
            checks.append(f"100 * {self.numerator} <= {self.at_most} * {self.denominator}")
        return f"(n_words < {self.from_words} OR ({' AND '.join(checks)}))"


#: The production table: mean word length 2 to 25, few symbols, some function words, few repeated lines.
RULES = (
    Rule("word length", "word_chars", "n_words", at_least=200, at_most=2500),
    Rule("symbols to words", "n_symbols", "n_words", at_most=30),
    Rule("stop words", "n_stop_words", "n_words", at_least=2, from_words=50),
    Rule("repeated lines", "n_dup_lines", "n_lines", at_most=50),
    Rule("unfinished lines", "n_open_lines", "n_lines", at_most=30),
    Rule("listed lines", "n_bullet_lines", "n_lines", at_most=90),
)


def _repeated_words(hashes: Column, n_words: Column) -> Column:
    """Words covered by windows of five words that occur at least twice."""
    windows = F.slice(
        F.transform(hashes, lambda _, i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)])),
        F.lit(1), F.greatest(n_words - (WINDOW - 1), F.lit(0)))

    def covered(at: Column) -> Column:
        widths = F.transform(at, lambda d, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - d, F.lit(WINDOW))))
        return F.aggregate(widths, F.lit(0).cast("long"), lambda total, x: total + x)

    def doubled(ordered: Column) -> Column:
        marked = F.transform(ordered, lambda s, k: F.struct(
            s["i"].alias("i"),
            (F.coalesce(F.get(ordered, k - 1)["h"] == s["h"], F.lit(False))
             | F.coalesce(F.get(ordered, k + 1)["h"] == s["h"], F.lit(False))).alias("twice")))
        return let(F.sort_array(F.transform(F.filter(marked, lambda x: x["twice"]), lambda x: x["i"])), covered)

    return let(windows, lambda found: F.when(
        F.size(F.array_distinct(found)) == F.size(found), F.lit(0).cast("long")
    ).otherwise(let(F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), doubled)))


def measures(text: Column) -> Column:
    """All counts of a text as one struct of longs; a null text counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def from_words(words: Column) -> Column:
        n = F.size(words)
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
            let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _repeated_words(h, n)).alias("n_repeat_words"),
        )

    def from_lines(lines: Column) -> Column:
        return F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.size(F.filter(lines, lambda x: F.endswith(x, F.lit("...")) | F.endswith(x, F.lit("…")))).cast("long").alias("n_open_lines"),
            F.size(F.filter(lines, lambda x: F.substring(x, 1, 1).isin("-", "*", "•"))).cast("long").alias("n_bullet_lines"),
        )

    lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit("[^ \\t-\\r]")))
    symbols = (F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))).cast("long")
    return let(F.struct(let(words_of(text), from_words).alias("w"), let(lines, from_lines).alias("l"), symbols.alias("s")),
               lambda m: F.struct(*[m["w"][c].alias(c) for c in ("n_words", "word_chars", "n_stop_words", "n_repeat_words")],
                                  *[m["l"][c].alias(c) for c in ("n_lines", "n_dup_lines", "n_open_lines", "n_bullet_lines")],
                                  m["s"].alias("n_symbols")))


def _verdict(m: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    base_failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
    kept = ~base_failed
    for rule in rules:
        kept = kept & rule.holds(m)
    return base_failed, kept


def quality(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add the struct ``quality``: all counts, ``base_failed`` and ``kept``.

    Other columns pass through untouched (an own column ``quality`` is replaced). A null or
    empty text has counts of 0 and fails; repeated rows are judged one by one; an empty table
    gives an empty one. Windows of words are told apart by 64-bit hashes within one text.
    """
    def judged(m: Column) -> Column:
        base_failed, kept = _verdict(m, rules)
        names = ("n_words", "word_chars", "n_symbols", "n_stop_words", "n_repeat_words",
                 "n_lines", "n_dup_lines", "n_open_lines", "n_bullet_lines")
        return F.struct(*[m[c].alias(c) for c in names], base_failed.alias("base_failed"), kept.alias("kept"))

    return docs.withColumn("quality", let(measures(F.col(text)), judged))


def check_sql(rules: Sequence[Rule] = RULES) -> str:
    """The DuckDB statement for the query over ``documents``."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    spaces = "[^ \\t\\n\\x0B\\f\\r]"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '{spaces}+') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{spaces}')) AS lines FROM d),
g AS (SELECT *, list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' ')) AS grams FROM w),
m AS (SELECT doc_id,
  len(words)::BIGINT AS n_words,
  length(array_to_string(words, ''))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  len(list_filter(words, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words,
  (SELECT count(*) FROM (SELECT DISTINCT unnest(range(i, i + 5)) FROM (
     SELECT unnest(range(1, len(grams) + 1)) AS i, unnest(grams) AS gram) a
     WHERE gram IN (SELECT gram FROM (SELECT unnest(grams) AS gram) GROUP BY gram HAVING count(*) > 1)))::BIGINT AS n_repeat_words,
  len(lines)::BIGINT AS n_lines,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  len(list_filter(lines, lambda x: x LIKE '%...' OR x LIKE '%…'))::BIGINT AS n_open_lines,
  len(list_filter(lines, lambda x: x[1] IN ('-', '*', '•')))::BIGINT AS n_bullet_lines
  FROM g),
b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND {" AND ".join(r.sql() for r in rules)}) AS kept,
  n_stop_words, n_lines, n_open_lines, n_bullet_lines
FROM b"""
