"""Tokenizers as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: English stop words
STOP_WORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves he him his himself
she she's her hers herself it it's its itself they them their theirs themselves what which who whom this that that'll
these those am is are was were be been being have has had having do does did doing a an the and but if or because as
until while of at by for with about against between into through during before after above below to from up down in
out on off over under again further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don don't should should've now d ll m o re ve y ain
aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn
mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

WORD = "[\\p{L}\\p{N}_]{2,}"


def basic_tokens(text: Column) -> Column:
    """Lower-case words with punctuation split off; quotes, semicolons and colons vanish."""
    plain = F.regexp_replace(F.lower(text), '<br />|[;:]', " ")
    spaced = F.regexp_replace(F.replace(plain, F.lit('"'), F.lit("")), "([.,()!?'])", " $1 ")
    return F.filter(F.split(spaced, "\\s+"), lambda w: w != "")


def without_stop_words(tokens: Column) -> Column:
    return F.filter(tokens, lambda w: ~F.lower(w).isin(STOP_WORDS))


def word_tokens(text: Column) -> Column:
    """Lower-case runs of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def digit_split(tokens: Column) -> Column:
    """A token holding a digit is replaced by its single digits, its letters are lost."""
    parts = F.transform(tokens, lambda w: F.when(
        w.rlike("[0-9]"), F.regexp_extract_all(w, F.lit("[0-9]"), F.lit(0))
    ).otherwise(F.array(w)))
    return F.flatten(parts)


BASIC_TOKENS_SQL = r"""list_filter(regexp_split_to_array(regexp_replace(replace(regexp_replace(lower(text), '<br />|[;:]', ' ', 'g'), '"', ''),
    '([.,()!?''])', ' \1 ', 'g'), '\s+'), lambda w: w <> '')"""
