"""A cheap guess whether a text is English, by its share of function words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillweave import schemas as S

# English function words, the least number of words, the least share.
FUNCTION_WORDS = (
    "the of and in to a is was were with for that by as on are this from be an or "
    "we which these at not have has been than between our its their it after"
)
LEAST_WORDS = 8
LEAST_SHARE = 0.12
#: Letters, letter numbers and other numbers: what Python's regex calls a word character but for digits and "_".
WORD = r"[\p{L}\p{Nl}\p{No}]+"


def guess_language(text: Column) -> Column:
    """`en`, `non-en`, or `unknown` for fewer than LEAST_WORDS words; a null text is empty."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))
    known = F.filter(found, lambda w: F.lower(w).isin(*FUNCTION_WORDS.split()))
    share = F.try_divide(F.size(known).cast("double"), F.size(found).cast("double"))
    return F.when(F.size(found) < LEAST_WORDS, "unknown").when(share >= LEAST_SHARE, "en").otherwise("non-en")


def nlp_scope(title: Column, abstract: Column) -> Column:
    """What of an article can be read as English: both parts, the title alone, or nothing."""
    usable = lambda c: (F.coalesce(c, F.lit("")) != "") & (guess_language(c) != "non-en")
    return F.when(usable(abstract), S.SCOPE_FULL).when(usable(title), S.SCOPE_TITLE).otherwise(S.SCOPE_NONE)
