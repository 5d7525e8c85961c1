"""BLEU tokenisation (mteval-v13a rules), as columns and for one line in a task."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .._util import as_col
from .text import WS_RUN

# --- fixed values: the 13a tokeniser of the standard BLEU tool --------------
# Entity unescaping, applied in this order.
UNESCAPES = (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))
# Regex rules (Java syntax) and replacements, applied in this order to
# " " + line + " ":
#  1. pad the symbols { | } ~ [ \ ] ^ _ ` space ! " # $ % & ( ) * + : ; < = > ? @ /
#  2. split period and comma unless preceded by a digit
#  3. split period and comma unless followed by a digit
#  4. split a dash preceded by a digit
# (Rule 1's class also lists the space itself; padding a space with spaces
# cannot change the tokens, so it is left out here.)
RULES_13A = (
    (r"([{-~\[-`!-&(-+:-@/])", " $1 "),
    (r"([^0-9])([.,])", "$1 $2 "),
    (r"([.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)
MAX_ORDER = 4
# The white space of text.WS_RUN within ASCII.
ASCII_WS_RUN = r"[ \x{09}-\x{0d}\x{1c}-\x{1f}]+"
# ---------------------------------------------------------------------------
#: Pieces of lines that a task remembers the tokens of, and their longest.
MEMO_PIECES, MEMO_CHARS = 100_000, 64


def normalize_13a(c) -> Column:
    """The 13a rules as one string expression; tokens are its space-separated words.

    The segment is right-stripped first, as the BLEU tool does before
    tokenising (so a trailing ``-\n`` is not joined). The regex only runs when
    the last character is whitespace.
    """
    raw = F.coalesce(as_col(c), F.lit(""))
    ends_ws = F.substring(raw, -1, 1).rlike("^" + WS_RUN + "$")
    line = F.when(ends_ws, F.regexp_replace(raw, WS_RUN + "$", "")).otherwise(raw)
    line = F.replace(line, F.lit("<skipped>"), F.lit(""))
    line = F.replace(line, F.lit("-\n"), F.lit(""))
    line = F.replace(line, F.lit("\n"), F.lit(" "))
    for src, dst in UNESCAPES:
        line = F.replace(line, F.lit(src), F.lit(dst))
    line = F.concat(F.lit(" "), line, F.lit(" "))
    for pattern, repl in RULES_13A:
        line = F.regexp_replace(line, pattern, repl)
    return line


def split_ws(line) -> Column:
    """Whitespace split; leading/trailing blanks give empty strings, removed. Text of one
    byte per character is split by the ASCII white space alone, which is quicker."""
    line = as_col(line)
    ascii_only = F.octet_length(line) == F.length(line)
    return F.array_remove(F.when(ascii_only, F.split(line, ASCII_WS_RUN)).otherwise(F.split(line, WS_RUN)), "")


def tokenize_13a(c) -> Column:
    """Array of BLEU tokens for one line."""
    return split_ws(normalize_13a(c))


_RULES = [(re.compile(pattern), repl.replace("$", "\\")) for pattern, repl in RULES_13A]


class Tokens13a:
    """``tokenize_13a`` of single lines inside a task.

    No rule sees more than one character before and after a mark, and to all of them a
    line's ends, blanks and other white space are the same: the tokens of a line are those
    of its pieces between white space, of which ``MEMO_PIECES`` at most are remembered.
    """

    def __init__(self):
        self.memo: dict[str, list[str]] = {}

    def of(self, line: str) -> list[str]:
        line = line.rstrip().replace("<skipped>", "")
        if "\n" in line:
            line = line.replace("-\n", "").replace("\n", " ")
        if "&" in line:
            for src, dst in UNESCAPES:
                line = line.replace(src, dst)
        tokens, memo = [], self.memo
        for piece in line.split():
            if piece.isalnum():
                tokens.append(piece)
            elif piece[-1] in ".," and piece[:-1].isalnum():
                tokens += piece[:-1], piece[-1]
            else:
                tokens += memo.get(piece) or self._piece(piece)
        return tokens

    def _piece(self, piece: str) -> list[str]:
        padded = f" {piece} "
        for pattern, repl in _RULES:
            padded = pattern.sub(repl, padded)
        tokens = padded.split()
        if len(piece) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_PIECES:
                self.memo.clear()
            self.memo[piece] = tokens
        return tokens
