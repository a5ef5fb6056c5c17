"""Text expressions: splitting, trimming, translation, tokens and stop words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# ASCII punctuation.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# The common English stop words.
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

# White space between tokens, spelled out so that every regular expression engine agrees on it.
SPACE = "[ \\t\\n\\r\\f]+"


def words(text: Column) -> Column:
    """White-space separated tokens."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def without_punctuation(text: Column) -> Column:
    return F.translate(text, PUNCTUATION, "")


def dash_to_space(text: Column) -> Column:
    """Hyphens become blanks, all other punctuation goes (a closing bracket goes too)."""
    return F.translate(text, "-" + PUNCTUATION.replace("-", ""), " ")


def without_stop_words(tokens: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Drop stop words; repeated words stay repeated."""
    return F.filter(tokens, lambda w: ~w.isin(list(stop_words)))


# A whole token of letters, between blanks or the ends of the text.
LETTERS_ONLY = "(?<![^ \\t\\n\\r\\f])\\p{L}+(?![^ \\t\\n\\r\\f])"


def clean_words(text: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Lower-case alphabetic words of a text without punctuation and stop words."""
    tokens = F.regexp_extract_all(without_punctuation(F.lower(text)), F.lit(LETTERS_ONLY), F.lit(0))
    return without_stop_words(tokens, stop_words)


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` worked out a single time, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def clean_text(text: Column, longer_than: int | None = None) -> Column:
    """Cleaned words joined by blanks; null when there are not more than ``longer_than`` of them."""
    if longer_than is None:
        return F.array_join(clean_words(text), " ")
    return once(clean_words(text), lambda w: F.when(F.size(w) > longer_than, F.array_join(w, " ")))


def long_clean_texts(df: DataFrame, column: str, longer_than: int = 50) -> DataFrame:
    """Clean a text column and keep the rows with more than ``longer_than`` words.

    The rows are dropped by an explode: a filter on the cleaned column would be moved
    before the cleaning and do that work twice.
    """
    cleaned = clean_text(F.col(column), longer_than)
    kept = F.filter(F.array(cleaned), lambda t: t.isNotNull())
    return df.withColumn(column, F.explode(kept))


def clean_string_columns(df: DataFrame, missing: str = "not in universe") -> DataFrame:
    """Trim, lower-case, null the ``missing`` phrase and drop punctuation and stop words everywhere."""
    out = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            low = F.lower(F.trim(c))
            low = F.when(low != missing, low)
            c = F.array_join(without_stop_words(words(dash_to_space(low))), " ").alias(field.name)
        out.append(c)
    return df.select(*out)


def ngrams(tokens: Column, n: int) -> Column:
    """Runs of ``n`` neighbouring tokens joined by blanks, with repeats."""
    starts = F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - (n - 1), F.lit(0)))
    return F.transform(
        starts, lambda first, i: F.concat_ws(" ", first, *[F.get(tokens, i + step) for step in range(1, n)]))


def head(items: Column) -> Column:
    return F.get(items, F.lit(0))


def rest(items: Column) -> Column:
    return F.slice(items, F.lit(2), F.greatest(F.size(items) - 1, F.lit(0)))


def sorted_unique(items: Column) -> Column:
    return F.array_sort(F.array_distinct(items))


def join_columns(*columns: str, skip_null: bool) -> Column:
    """Columns joined by blanks; a null field is skipped, or makes the result null."""
    if skip_null:
        return F.concat_ws(" ", *columns)
    parts = []
    for c in columns:
        parts += [F.lit(" "), F.col(c).cast("string")]
    return F.concat(*parts[1:])


def date_time(date: Column, time: Column, pattern: str = "yyyy/MM/dd HH:mm:ss") -> Column:
    """Timestamp from a date string and a time string."""
    return F.to_timestamp(F.concat_ws(" ", date, time), pattern)
