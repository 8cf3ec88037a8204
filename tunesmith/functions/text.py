"""Column -> Column string helpers shared by every group.

Python's str.strip(), str.split() and re's ``\\s`` treat a wider set of characters
as whitespace than Spark's ``trim`` or Java's ``\\s``; these helpers use one
shared set so that results agree with the Python semantics they model.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters for which Python's str.isspace() is true
# (what str.strip(), str.split() and re "\s" use), as code points:
# U+0009-000D, U+001C-0020, U+0085, U+00A0, U+1680, U+2000-200A,
# U+2028, U+2029, U+202F, U+205F, U+3000.
WHITESPACE_CODEPOINTS = (
    list(range(0x09, 0x0E))
    + list(range(0x1C, 0x21))
    + [0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B))
    + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)
WHITESPACE_CHARS = "".join(chr(c) for c in WHITESPACE_CODEPOINTS)
# The same set as a regex class; both Java and RE2 accept \x{...} escapes.
WHITESPACE_CLASS = (
    r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
)

# ASCII punctuation, the 32 characters of Python's string.punctuation.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Native tokenizer: a run of letters/digits/underscore, or one other non-space character.
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ustrip(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.trim(col_(c), F.lit(WHITESPACE_CHARS))


def split_ws(c) -> Column:
    """Python ``str.split()`` with no argument: whitespace runs, no empty pieces."""
    return F.filter(F.split(col_(c), WHITESPACE_CLASS + "+"), lambda x: x != F.lit(""))


def collapse_ws(c) -> Column:
    return F.regexp_replace(col_(c), WHITESPACE_CLASS + "+", " ")


def strip_punctuation(c) -> Column:
    """Delete the ASCII punctuation characters (translate with an empty target)."""
    return F.translate(col_(c), ASCII_PUNCTUATION, "")


def normalize_answer(c) -> Column:
    """lower -> strip -> delete ASCII punctuation -> collapse whitespace.

    There is deliberately no second strip: "Paris !" normalizes to "paris ".
    """
    return collapse_ws(strip_punctuation(ustrip(F.lower(col_(c)))))


def tokenize(c) -> Column:
    """Native word/punctuation tokenizer: text -> array<string>."""
    return F.regexp_extract_all(col_(c), F.lit(TOKEN_PATTERN), 0)


def ids_text(c) -> Column:
    """array<int> rendered as '1,2,3' (order kept) for stable comparison and display."""
    return F.array_join(col_(c).cast("array<string>"), ",")


def round6(c) -> Column:
    return F.round(col_(c).cast("double"), 6)


def explode_values(c) -> Column:
    """``explode_outer`` for arrays without null elements; callers drop the null row.

    Plain ``explode`` makes the optimizer add a ``size(array) > 0`` filter in front
    of the generator, inlining the whole array expression a second time; when that
    array comes from a higher-order function over another computed array the copy
    is re-evaluated per element (quadratic). explode_outer has no inferred filter.
    """
    return F.explode_outer(col_(c))


def word_ngrams(words, n: int) -> Column:
    """Distinct word n-grams (space-joined) of a word array; [] when it has fewer than n words.

    Built from ``arrays_zip`` of n shifted slices, so the lambda only reads its own
    struct argument. (A lambda that captures a computed array gets that array's
    expression inlined into its body by the optimizer and re-evaluated per element.)
    """
    w = col_(words)
    m = F.greatest(F.size(w) - n + 1, F.lit(0))
    zipped = F.arrays_zip(*[F.slice(w, k + 1, m).alias(f"w{k}") for k in range(n)])
    grams = F.transform(zipped, lambda s: F.concat_ws(" ", *[s[f"w{k}"] for k in range(n)]))
    return F.when(F.size(w) >= n, F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))
