"""Scalar column functions over text (all JVM-side).

Every function takes and returns a ``Column`` so it composes into one
``select`` and stays inside whole-stage codegen. Regular expressions are Java
patterns; ``(?U)`` turns ``\\s`` into Unicode whitespace.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._util import as_col

# --- fixed values (must equal the reference's behaviour) --------------------
# Characters whose presence marks Latin-1/UTF-8 mojibake.
MOJIBAKE_MARKERS = ("Ã", "Â", "â", "ð", "ï")
# Lower-cased source texts that are never valid pairs.
DROPPED_EXACT_SOURCES = ("translator-credits", "n/a")
# Python's str.split()/str.strip() whitespace = Unicode White_Space plus the
# four information separators U+001C..U+001F.
WS_CLASS = r"[\s\x{1c}-\x{1f}]"
WS_RUN = r"(?U)" + WS_CLASS + "+"
NON_WS_RUN = r"(?U)[^\s\x{1c}-\x{1f}]+"
# Code points below 32 except TAB.
CONTROL_CLASS = r"[\x{00}-\x{08}\x{0A}-\x{1F}]"
# Sentence boundary: whitespace after . ! ? or a run of (CR)LF line breaks
# (the reference's pattern); the split uses the widened form below.
SENTENCE_BOUNDARY = r"(?U)(?<=[.!?])" + WS_CLASS + r"+|\r?\n+"
SENTENCE_BOUNDARY_WIDE = (r"(?U)" + WS_CLASS + r"*(?:(?<=[.!?])" + WS_CLASS + r"+|\r?\n+)"
                          + WS_CLASS + r"*")
CJK_CLASS = r"[\x{4e00}-\x{9fff}]"
# Where the JVM's GBK table differs from the repair's: characters only the JVM has (euro
# sign, earth sign, private use), and the circled plus, which it codes as the earth sign.
GBK_JVM_ONLY = r"[\x{20ac}\x{2641}\x{e000}-\x{f8ff}]"
GBK_JVM_OTHER = ("\u2295", "\u2641")
FLOAT_IN_TEXT = r"[-+]?\d*\.?\d+"
# ---------------------------------------------------------------------------


def normalize_space(c) -> Column:
    """NULL -> ''; trim; every run of Unicode whitespace -> one space."""
    c = as_col(c)
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), WS_RUN, " "))


def normalize_cleaned(c) -> Column:
    """``normalize_space`` of a cleaned side (``finish_side``), where blanks are the only
    white space and stand together only where an underscore went: seldom a regex."""
    c = F.coalesce(as_col(c), F.lit(""))
    return F.trim(F.when(F.contains(c, F.lit("  ")), F.regexp_replace(c, " +", " ")).otherwise(c))


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    c = as_col(c)
    return F.regexp_replace(c, r"^" + WS_RUN + r"|" + WS_RUN + r"$", "")


def strip_accelerator(c) -> Column:
    """Delete every underscore (menu accelerators ``_File``)."""
    return F.replace(as_col(c), F.lit("_"), F.lit(""))


def remove_control_chars(c) -> Column:
    """Delete code points < 32 except TAB; newline is deleted, not spaced."""
    return F.regexp_replace(as_col(c), CONTROL_CLASS, "")


def _marker_count(c: Column) -> Column:
    """Number of *distinct* mojibake markers present."""
    total = F.lit(0)
    for m in MOJIBAKE_MARKERS:
        total = total + F.when(F.instr(c, m) > 0, 1).otherwise(0)
    return total


def latin1_candidate(c) -> Column:
    """Latin-1 bytes of ``c`` decoded as strict UTF-8, or NULL.

    Only text with a marker and made solely of U+0000..U+00FF is encoded: the
    guard sits on the *argument*, so ``encode`` never sees unmappable text.
    """
    c = as_col(c)
    guard = c.rlike("[" + "".join(MOJIBAKE_MARKERS) + "]") & c.rlike(r"^[\x{00}-\x{ff}]*$")
    return F.try_validate_utf8(F.encode(F.when(guard, c), "ISO-8859-1").cast("string"))


def accept_latin1(c, candidate) -> Column:
    """Keep the candidate only if it has strictly fewer distinct markers."""
    c, candidate = as_col(c), as_col(candidate)
    accept = candidate.isNotNull() & (_marker_count(candidate) < _marker_count(c))
    return F.when(accept, candidate).otherwise(c)


def fix_mojibake_latin1(c) -> Column:
    """Undo UTF-8 bytes read as Latin-1, e.g. ``EspaÃ±a`` -> ``España``.

    Column form for single use; ``clean_columns`` stages the same two steps as
    separate projections so the candidate is computed once.
    """
    return accept_latin1(c, latin1_candidate(c))


def gbk_escapes(c) -> Column:
    """GBK bytes of ``c`` as percent escapes, or NULL where there is nothing to repair
    (no CJK character) or a character has no GBK code.

    Spark's ``encode`` knows no GBK, the JVM's URL encoder does. It writes ``?`` for a
    character without a code, which shows as one ``%3F`` more than ``c`` has ``?``.
    """
    c = as_col(c)
    guarded = F.when(c.rlike(CJK_CLASS) & ~c.rlike(GBK_JVM_ONLY), F.translate(c, *GBK_JVM_OTHER))
    escapes = F.reflect(F.lit("java.net.URLEncoder"), F.lit("encode"), guarded, F.lit("GBK"))
    return F.when(guarded.isNotNull(), escapes)


def accept_gbk(c, escapes) -> Column:
    """``escapes`` read as UTF-8 if that is valid and leaves fewer CJK characters, else ``c``.

    The decoder marks invalid bytes by U+FFFD; text that really holds that character
    (three bytes of its own) is told apart by looking with a letter in its place.
    """
    c, escapes = as_col(c), as_col(escapes)
    mapped = F.regexp_count(escapes, F.lit("%3F")) == F.regexp_count(c, F.lit(r"\?"))
    valid = ~F.contains(F.url_decode(F.replace(escapes, F.lit("%EF%BF%BD"), F.lit("x"))), F.lit("\ufffd"))
    fixed = F.url_decode(escapes)
    fewer = F.regexp_count(fixed, F.lit(CJK_CLASS)) < F.regexp_count(c, F.lit(CJK_CLASS))
    return F.when(mapped & valid & fewer, fixed).otherwise(c)


def fix_mojibake_gbk(c) -> Column:
    """Undo UTF-8 bytes read as GBK, e.g. ``F谩brica`` -> ``Fábrica`` (P5).

    Runs in the JVM; only text with CJK is encoded at all. Column form for single
    use; ``clean_columns`` stages the two steps as separate projections.
    """
    return accept_gbk(c, gbk_escapes(c))


def fix_mojibake(c) -> Column:
    """P4 then P5 on the P4 result."""
    return fix_mojibake_gbk(fix_mojibake_latin1(c))


def finish_side(c) -> Column:
    """Control chars -> whitespace -> underscores, the tail of P6."""
    return strip_accelerator(normalize_space(remove_control_chars(as_col(c))))


def clean_text(c) -> Column:
    """One side of a pair: mojibake -> control chars -> spaces -> underscores.

    Underscores go last, so ``"_ foo"`` becomes ``" foo"``; a later
    ``normalize_space`` (as on read) removes such leftovers. For whole
    DataFrames prefer ``operators.clean.clean_columns``, which stages the
    steps as projections.
    """
    return finish_side(fix_mojibake(F.coalesce(as_col(c), F.lit(""))))


def token_count(c) -> Column:
    """Number of whitespace-separated tokens."""
    return F.regexp_count(F.coalesce(as_col(c), F.lit("")), F.lit(NON_WS_RUN))


def token_count_normalized(c) -> Column:
    """Token count of text already passed through ``normalize_space``."""
    c = as_col(c)
    return F.when(c == "", F.lit(0)).otherwise(F.size(F.split(c, " ")))


def tokens(c) -> Column:
    """Whitespace tokens as an array (Python ``str.split()``)."""
    s = normalize_space(c)
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, " "))


def split_sentences(c) -> Column:
    """Array of sentences, in order, stripped, empties dropped.

    Splitting on a boundary widened by the whitespace around it is the same
    as splitting on the bare boundary and stripping every part, without a
    per-element lambda. Use with ``posexplode`` for ``(pos, sentence)``.
    """
    text = strip_ws(F.coalesce(as_col(c), F.lit("")))
    return F.array_remove(F.split(text, SENTENCE_BOUNDARY_WIDE), "")


def safe_float(c) -> Column:
    """Parse a float; else the first number inside the text; else 0.0."""
    s = as_col(c).cast("string")
    extracted = F.nullif(F.regexp_extract(s, FLOAT_IN_TEXT, 0), F.lit(""))
    return F.coalesce(s.try_cast("double"), extracted.try_cast("double"), F.lit(0.0))


def pct_change(new, old) -> Column:
    """(new - old) / old * 100, and 0 when old = 0."""
    new, old = as_col(new), as_col(old)
    return F.when(old == 0, F.lit(0.0)).otherwise((new - old) / old * F.lit(100.0))


def format_metric(c, digits: int) -> Column:
    """Fixed-point text such as ``%.4f``."""
    return F.format_string(f"%.{int(digits)}f", as_col(c))
