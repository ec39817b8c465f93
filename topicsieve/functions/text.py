"""Text primitives shared by extraction, keyword and TF-IDF features.

All of them are column expressions, so they run inside the JVM next to the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, as a character set and as a regex class.
SPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# Unicode word characters; the JVM's own \w is ASCII-only.
WORD = r"\p{L}\p{N}_"
TOKEN_PATTERN = rf"[{WORD}]{{2,}}"

# The English stop list distributed with Spark ML.
DEFAULT_STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you your yours yourself yourselves he him his
    himself she her hers herself it its itself they them their theirs themselves what
    which who whom this that these those am is are was were be been being have has had
    having do does did doing a an the and but if or because as until while of at by for
    with about against between into through during before after above below to from up
    down in out on off over under again further then once here there when where why how
    all any both each few more most other some such no nor not only own same so than too
    very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd
    you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've
    you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't
    won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's
    let's ought that's there's what's when's where's who's why's would
    """.split()
)


def strip(col: Column) -> Column:
    """Trim every Unicode white-space character at both ends."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def squeeze(col: Column) -> Column:
    """Collapse runs of white space to one space, then trim."""
    return strip(F.regexp_replace(col, rf"[{SPACE}]+", " "))


def non_empty(*cols: Column) -> Column:
    """First argument that is neither null nor the empty string, else ''."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols], F.lit(""))


def is_blank(col: Column) -> Column:
    return F.coalesce(strip(col), F.lit("")) == ""


def round_half_up(col: Column, places: int) -> Column:
    """Decimal rounding that gives the same double on every engine."""
    scale = 10**places
    return F.floor(col * F.lit(float(scale)) + F.lit(0.5)) / F.lit(float(scale))


def tokens(text: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))


def drop_stop_words(token_array: Column, stop_words: Sequence[str] = DEFAULT_STOP_WORDS) -> Column:
    # isin with many literals becomes a hash-set test, unlike array_contains.
    if not stop_words:
        return token_array
    return F.filter(token_array, lambda t: ~t.isin(*stop_words))


def ngrams_1_2(token_array: Column) -> Column:
    """Unigrams followed by bigrams.

    ``token_array`` must be a materialised column (not an expression), because it
    is referenced several times.
    """
    pairs = F.greatest(F.size(token_array) - 1, F.lit(0))
    bigrams = F.zip_with(
        F.slice(token_array, F.lit(1), pairs),
        F.slice(token_array, F.lit(2), pairs),
        lambda left, right: F.concat(left, F.lit(" "), right),
    )
    return F.concat(token_array, bigrams)
