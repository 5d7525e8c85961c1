"""Glossary term protection and restoration.

Terms are literals without word boundaries, compared without case, and each is applied
to the text as the terms before it left it. A term can change a text only if the text
contains it, or if it meets a placeholder that an earlier term put there.

A glossary of at most ``HELD_TERMS`` terms goes to the tasks, which find all occurrences in
many texts at a time by a trie and replace those that are free in order of the terms, where
the texts are read (``HeldGlossary``): no join and no shuffle. A larger one stays a table,
whatever its size:

* every term has one key, the first ``SHINGLE`` characters of its folded form; a
  text's shingles of the lengths in use are equi-joined with the keys, and a
  candidate stays if the folded text contains the folded term;
* the few terms that can touch a placeholder (``TOUCHES``) are further candidates of
  every text that has one.

A text's candidates are applied in rank order in one fold over that text's own list.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .._util import as_col, explode_rows, require_columns
from ..functions.text import strip_ws
from .rank import global_rank

#: Characters of an index key (fewer for shorter terms).
SHINGLE = 4
#: Terms, and characters of terms and targets, of a glossary that tasks hold.
HELD_TERMS = 100_000
HELD_CHARS = 4_000_000
#: Characters of a term by which a task's trie finds it, and cells of the trie's table.
TRIE_DEPTH = 16
TRIE_CELLS = 2_000_000
#: Bytes of the texts that a task works on at a time.
SLICE_BYTES = 1 << 18
#: Different characters that a shingle's pattern may list.
ALPHABET = 200
#: Copies of the placeholder-touching terms that texts are spread over.
SALTS = 32
MAPPING_TYPE = "array<struct<placeholder:string,target:string>>"
# Letters whose single-character case folding is another letter's although their upper
# cases differ: dotted capital I, capital sharp s, Greek theta symbol and the ohm, kelvin and
# angstrom signs.
SPECIAL_FOLDS = {"İ": "I", "ẞ": "ß", "ϴ": "Θ", "Ω": "Ω", "K": "K",
                 "Å": "Å"}
# Letters with a case in Python's Unicode, but none in the JVM's (17: Unicode 13).
NEWER_LETTERS = ((0x2C2F, 0x2C2F), (0x2C5F, 0x2C5F), (0xA7C0, 0xA7C1), (0xA7D0, 0xA7D1), (0xA7D6, 0xA7D9), (0x10570, 0x105BF))
# Folded terms that can overlap ``__TERM_<n>__``: one of their ends is an end of it, they
# contain it, or they are a part of it.
TOUCHES = (r"^_|_$|__T(E(RM?)?)?$|__TERM_\d+|^(\d+|((T?E)?R)?M_\d+)__"
           r"|^(T(E(RM?)?)?|E(RM?)?|RM?|M)$|^\d+$|^((T?E)?R)?M_\d+$")


def placeholder(i) -> Column:
    """Placeholder of the term at position ``i`` of the length-descending order."""
    return F.concat(F.lit("__TERM_"), as_col(i).cast("string"), F.lit("__"))


def quoted_pattern(term) -> Column:
    """Case-insensitive Java regex of a literal (``\\Q..\\E``, splitting any ``\\E``)."""
    inner = F.replace(as_col(term), F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    return F.concat(F.lit("(?iu)\\Q"), inner, F.lit("\\E"))


def fold_case(c) -> Column:
    """Upper case that is equal wherever ``(?iu)`` finds characters equal."""
    return F.upper(F.translate(as_col(c), "".join(SPECIAL_FOLDS), "".join(SPECIAL_FOLDS.values())))


def normalize_glossary(df: DataFrame, source_col: str = "source_term",
                       target_col: str = "target_term", ord_col: str = "ord") -> DataFrame:
    """Trim, drop empty terms; a repeated source term keeps its first position
    and its last target (dictionary semantics). Case-sensitive keys."""
    require_columns(df, source_col, target_col, ord_col)
    g = df.select(F.col(ord_col).alias("ord"), strip_ws(source_col).alias("source_term"),
                  strip_ws(target_col).alias("target_term"))
    g = g.filter((F.col("source_term") != "") & (F.col("target_term") != ""))
    return g.groupBy("source_term").agg(F.min("ord").alias("ord"),
                                        F.max_by("target_term", "ord").alias("target_term"))


def glossary_terms(glossary, spark: SparkSession | None = None) -> DataFrame:
    """``(position, source_term, target_term)``: longest first, ties by ``ord``.

    ``glossary`` is a table ``(ord, source_term, target_term)`` or a list of
    ``(source, target)``. Ranked by a distributed range sort and written once.
    """
    if not isinstance(glossary, DataFrame):
        rows = [(i, s, t) for i, (s, t) in enumerate(glossary)]
        glossary = spark.createDataFrame(rows, "ord long, source_term string, target_term string")
    ranked = global_rank(normalize_glossary(glossary), F.length("source_term").desc(), "ord", "source_term",
                         rank_col="position", offset=-1)
    return ranked.select("position", "source_term", "target_term")


def candidates(texts: DataFrame, text_col: str, terms: DataFrame) -> DataFrame:
    """``(text, terms)``: per distinct text with at least one occurring term, the
    candidate terms ``(position, pattern, target)`` in order."""
    terms = terms.withColumn("folded", fold_case("source_term"))
    size = F.least(F.length("folded"), F.lit(SHINGLE))
    touches = F.col("folded").rlike(TOUCHES)
    # One small job: at most SHINGLE lengths, one number, and the keys' letters.
    letters = [F.collect_set(F.substring("folded", at, 1)) for at in (1, 2)]
    lengths, touching, *starts = terms.agg(F.collect_set(size), F.count_if(touches), *letters).first()
    entry = F.struct("position", quoted_pattern("source_term").alias("pattern"), F.col("target_term").alias("target"))
    index = terms.select(F.substring("folded", 1, SHINGLE).alias("key"), "folded", entry.alias("term"))

    # Distinct texts: repeated ones are looked up once, and all that follows is
    # already dealt by text (with its own generated code, small enough to be compiled).
    texts = texts.select(as_col(text_col).alias("text")).distinct()
    folded = texts.select("text", fold_case("text").alias("_folded"))
    parts = [F.regexp_extract_all("_folded", F.lit(_shingle_pattern(n, *starts)), F.lit(1)) for n in sorted(lengths)]
    shingles = F.concat(*parts) if parts else F.array().cast("array<string>")
    keyed = explode_rows(folded, ["text", "_folded"], shingles, ("key",))
    found = keyed.join(index, "key").where(F.contains("_folded", "folded"))
    per_text = found.groupBy("text").agg(F.collect_set("term").alias("terms"))
    if touching:
        salted = index.where(touches).select("term", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        more = per_text.withColumn("salt", F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int")).join(salted, "salt")
        more = more.groupBy("text").agg(F.collect_set("term").alias("more"))
        per_text = per_text.join(more, "text").select("text", F.array_union("terms", "more").alias("terms"))
    return per_text.select("text", F.array_sort("terms").alias("terms"))


def _shingle_pattern(n: int, first: list[str], second: list[str]) -> str:
    """Regex of all (overlapping) shingles of ``n`` characters that start like a key: its
    first two characters are first and second ones of keys. This only saves rows; alphabets
    of more than ``ALPHABET`` characters are not listed."""
    def one_of(chars):
        chars = sorted(set(chars) - {""})
        return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in chars) + "]" if 0 < len(chars) <= ALPHABET else "."

    heads = [one_of(first), one_of(second)][:n]
    return f"(?s)(?=({''.join(heads)}.{{{n - len(heads)}}}))"


class CaseFolds(dict):
    """Code point -> the letter that stands for all letters which ``(?iu)`` finds equal to it:
    the lower case of its upper case, both of one letter."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        if any(lo <= code <= hi for lo, hi in NEWER_LETTERS):
            self[code] = c
            return c
        upper = next((u for u in (c.upper(), c.title()) if len(u) == 1), c)
        self[code] = upper.lower()[0]
        return self[code]


class TermTrie:
    """Finds all occurrences of folded terms in texts written as letter classes.

    A state is a beginning of terms, numbered by length and then by letters, so that the
    sorted edges ``state * classes + class`` lead to the states in order. Terms longer than
    ``TRIE_DEPTH`` are compared from there on.
    """

    def __init__(self, terms: list[str]):
        self.classes = {c: k for k, c in enumerate(sorted(set().union(*terms)), 1)}
        self.width = len(self.classes) + 1
        first: dict[str, int] = {}
        for i, term in enumerate(terms):
            first.setdefault(term, i)
        numbers = np.fromiter(first.values(), np.int64, len(first))
        heads = [[self.classes[c] for c in term[:TRIE_DEPTH]] for term in first]
        size = np.array([len(h) for h in heads], np.int64)
        state, edges, states = np.zeros(len(heads), np.int64), [np.zeros(0, np.int64)], 1
        for at in range(size.max(initial=0)):
            some = np.flatnonzero(size > at)
            keys = state[some] * self.width + np.array([heads[k][at] for k in some.tolist()], np.int64)
            found, back = np.unique(keys, return_inverse=True)
            edges.append(found)
            state[some] = states + back
            states += len(found)
        self.edges = np.concatenate(edges)
        top = min(states, max(1, TRIE_CELLS // self.width))
        self.dense = np.zeros(top * self.width, np.int64)
        inside = self.edges[:np.searchsorted(self.edges, len(self.dense))]
        self.dense[inside] = np.arange(1, len(inside) + 1)
        self.term = np.full(states, -1, np.int64)
        self.longer: dict[int, list[tuple[int, np.ndarray]]] = {}
        for k, term in enumerate(first):
            if len(term) <= TRIE_DEPTH:
                self.term[state[k]] = numbers[k]
            else:
                rest = np.array([self.classes[c] for c in term[TRIE_DEPTH:]], np.int64)
                self.longer.setdefault(int(state[k]), []).append((int(numbers[k]), rest))

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The next states, 0 where there is none."""
        key = state * self.width + letter
        if len(self.dense) == len(self.term) * self.width:
            return self.dense[key]
        known = key < len(self.dense)
        at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
        return np.where(known, self.dense[np.where(known, key, 0)], np.where(self.edges[at] == key, at + 1, 0))

    def occurrences(self, letters: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Length -> starts in order, and the terms there. Class 0 is in no term; it ends each text."""
        found, at, depth = {}, np.flatnonzero(letters), 0
        state = np.zeros(len(at), np.int64)
        while len(at) and depth < TRIE_DEPTH:
            state = self.step(state, letters[at + depth])
            alive = np.flatnonzero(state)
            at, state, depth = at[alive], state[alive], depth + 1
            term = self.term[state]
            ends = np.flatnonzero(term >= 0)
            if len(ends):
                found[depth] = at[ends], term[ends]
        longer: dict[int, list[tuple[int, int]]] = {}
        for start, here in zip(at.tolist(), state.tolist()) if self.longer else ():
            for i, rest in self.longer.get(here, ()):
                if np.array_equal(letters[start + TRIE_DEPTH:start + TRIE_DEPTH + len(rest)], rest):
                    longer.setdefault(TRIE_DEPTH + len(rest), []).append((start, i))
        return found | {n: tuple(np.array(x, np.int64) for x in zip(*pairs)) for n, pairs in longer.items()}


class HeldGlossary:
    """A task's copy of a glossary: ``(position, source_term, target_term)`` in order, longest
    first. It works on the letters of many texts at a time.

    A term without ``_`` is met in what the terms before it left of the text, or inside a
    placeholder, never across its border. So the texts' own occurrences are taken in order
    where they are still free, and what later terms do to a placeholder is the same in every
    text. Only a glossary with a term that can meet a placeholder's border is applied term
    by term to each text that holds one of its terms.
    """

    def __init__(self, terms: list[tuple[int, str, str]]):
        self.folds = CaseFolds()
        self.terms = [self.fold(source) for _, source, _ in terms]
        self.marks = [f"__TERM_{position}__" for position, _, _ in terms]
        self.entries = pa.StructArray.from_arrays(
            [pa.array(self.marks, pa.string()), pa.array([target for _, _, target in terms], pa.string())],
            ["placeholder", "target"])
        touches = re.compile(TOUCHES, re.ASCII | re.IGNORECASE)
        self.touching = [i for i, term in enumerate(self.terms) if touches.search(term)]
        self.bordering = any("_" in self.terms[i] for i in self.touching)
        self.trie = TermTrie(self.terms)
        #: Class of a letter by code point, -1 until it is met.
        self.letter = np.full(0x110000, -1, np.int32)
        self.finals: dict[int, tuple[str, tuple[int, ...]]] = {}

    def fold(self, text: str) -> str:
        """As many characters as ``text``; terms match where their folded forms are equal."""
        return text.lower() if text.isascii() else text.translate(self.folds)

    def applied(self, text: str, numbers: Iterable[int]) -> tuple[str, tuple[int, ...]]:
        """The text after these terms, one by one, and those that it held."""
        folded, used = self.fold(text), []
        for i in numbers:
            term = self.terms[i]
            if term in folded:
                parts, kept, at = folded.split(term), [], 0
                for part in parts:
                    kept.append(text[at:at + len(part)])
                    at += len(part) + len(term)
                text, folded = self.marks[i].join(kept), self.marks[i].lower().join(parts)
                used.append(i)
        return text, tuple(used)

    def final(self, i: int) -> tuple[str, tuple[int, ...]]:
        """A term's placeholder as the terms after it leave it, and those that it held."""
        if i not in self.finals:
            self.finals[i] = self.applied(self.marks[i], self.touching[bisect_right(self.touching, i):])
        return self.finals[i]

    def classes(self, codes: np.ndarray) -> np.ndarray:
        """The code points' letter classes."""
        known = self.letter[codes]
        if known.min(initial=0) < 0:
            for code in np.unique(codes[known < 0]).tolist():
                self.letter[code] = self.trie.classes.get(self.fold(chr(code)), 0)
            known = self.letter[codes]
        return known

    def protect(self, texts: pa.StringArray) -> tuple[pa.StringArray, pa.ListArray]:
        """The texts with placeholders, and their maps."""
        count = len(texts)
        cuts = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + count + 1].astype(np.int64)
        data = texts.buffers()[2]
        data = data.slice(cuts[0], cuts[-1] - cuts[0]) if data is not None else pa.py_buffer(b"")
        cuts -= cuts[0]
        # Every text's letters, and a place of class 0 behind them; bytes: where a place begins.
        starts = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
        codes = np.frombuffer(data.to_pybytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        sizes = np.diff(np.concatenate([[0], np.cumsum(starts)])[cuts])
        ends = np.cumsum(sizes + 1)
        places = np.arange(len(codes)) + np.repeat(np.arange(count), sizes)
        letters, begins = np.zeros(len(codes) + count, np.int64), np.zeros(len(codes) + count, np.int64)
        letters[places], begins[places] = self.classes(codes), np.flatnonzero(starts)
        begins[ends - 1] = cuts[1:]
        found = self.trie.occurrences(letters)
        if self.bordering:
            return self.one_by_one(texts, found, ends)
        at, term, size = self.free(found, len(letters))
        text = np.searchsorted(ends, at, "right")
        kinds, kind = np.unique(term, return_inverse=True)
        finals = [self.final(i) for i in kinds.tolist()]
        used = self.pairs(text, term)
        more = np.array([len(u) for _, u in finals], np.int64)
        if more.any():
            values = np.array([i for _, u in finals for i in u], np.int64)
            row, kind_of = np.divmod(used, max(1, len(self.terms)))
            kind_of = np.searchsorted(kinds, kind_of)
            n = more[kind_of]
            first = (np.cumsum(more) - more)[kind_of]
            index = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            used = self.pairs(np.concatenate([row, np.repeat(row, n)]),
                              np.concatenate([kinds[kind_of], values[index]]))
        if len(at):
            texts = replaced(data, cuts, begins[at], begins[at + size], pa.array([t for t, _ in finals], pa.string()), kind)
        return texts, self.maps(used, count)

    def free(self, found: dict[int, tuple[np.ndarray, np.ndarray]], places: int):
        """``(start, term, size)`` of the occurrences that are replaced, in order of starts. Those
        taken before are as long or longer, so one that is not free has an end in one of them."""
        taken = bytearray(places)
        seen, kept = np.frombuffer(taken, np.uint8), []
        for size in sorted(found, reverse=True):
            at, term = found[size]
            free = np.flatnonzero((seen[at] | seen[at + size - 1]) == 0)
            at, term = at[free], term[free]
            near = np.diff(at) < size
            clash = np.concatenate([near, [False]]) | np.concatenate([[False], near])
            good = ~clash[:len(at)]
            seen[(at[good][:, None] + np.arange(size)).ravel()] = 1
            clash = np.flatnonzero(~good)
            clash = clash[np.lexsort((at[clash], term[clash]))]
            for k, start in zip(clash.tolist(), at[clash].tolist()):
                if not (taken[start] or taken[start + size - 1]):
                    taken[start:start + size] = b"\1" * size
                    good[k] = True
            kept.append((at[good], term[good], np.full(int(good.sum()), size, np.int64)))
        at, term, size = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*kept)) if kept else np.zeros((3, 0), np.int64)
        order = np.argsort(at)
        return at[order], term[order], size[order]

    def pairs(self, text: np.ndarray, term: np.ndarray) -> np.ndarray:
        """Different pairs of a text and a term as one number, in order."""
        pairs = np.sort(text * max(1, len(self.terms)) + term)
        return pairs[np.diff(pairs, prepend=-1) > 0]

    def maps(self, used: np.ndarray, count: int) -> pa.ListArray:
        width = max(1, len(self.terms))
        offsets = np.searchsorted(used, np.arange(count + 1) * width).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), self.entries.take(pa.array(used % width)))

    def one_by_one(self, texts: pa.StringArray, found: dict, ends: np.ndarray) -> tuple[pa.StringArray, pa.ListArray]:
        """The definition: the terms that a text holds or that touch placeholders, in order."""
        count, width = len(texts), max(1, len(self.terms))
        pairs = [self.pairs(np.searchsorted(ends, at, "right"), term) for at, term in found.values()]
        here: dict[int, list[int]] = {}
        for pair in np.sort(np.concatenate([np.zeros(0, np.int64), *pairs])).tolist():
            here.setdefault(pair // width, []).append(pair % width)
        out, used = texts.to_pylist(), []
        for row, numbers in here.items():
            out[row], held = self.applied(out[row], sorted({*numbers, *self.touching}))
            used += [row * width + i for i in held]
        return pa.array(out, pa.string()), self.maps(np.array(used, np.int64), count)


def replaced(data: pa.Buffer, cuts: np.ndarray, first: np.ndarray, last: np.ndarray, values: pa.StringArray,
             kind: np.ndarray) -> pa.StringArray:
    """The texts that lie between ``cuts`` of ``data`` with ``values[kind]`` for the bytes from ``first`` to ``last``."""
    bounds = np.concatenate([[0], np.stack([first, last], 1).ravel(), [cuts[-1]]]).astype(np.int32)
    parts = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), data)
    inner = pa.array(np.arange(len(parts)) % 2 == 1)
    parts = pc.replace_with_mask(parts, inner, values.take(pa.array(kind)))
    # What the parts hold, one behind the other, are the new texts.
    grown = np.concatenate([[0], np.cumsum(pc.binary_length(values).to_numpy()[kind] - (last - first))])
    offsets = (cuts + grown[np.searchsorted(first, cuts)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(cuts) - 1, pa.py_buffer(offsets), parts.buffers()[2])


def held_terms(terms: DataFrame) -> list[tuple[int, str, str]] | None:
    """The ranked terms in order, or None if they are too many for a task to hold. The
    pattern of a lone sharp s, unlike that of longer terms, does not find the capital one."""
    chars = F.sum((F.length("source_term") + F.length("target_term")).cast("long"))
    count, size, odd = terms.agg(F.count(F.lit(1)), F.coalesce(chars, F.lit(0)),
                                 F.count_if(F.col("source_term") == "ß")).first()
    if count > HELD_TERMS or size > HELD_CHARS or odd:
        return None
    return sorted(tuple(r) for r in terms.select("position", "source_term", "target_term").collect())


def _protected(held: list[tuple[int, str, str]]):
    """``text -> (text, map)`` as a column function over Arrow batches."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        glossary = HeldGlossary(held)
        for batch in batches:
            done = [glossary.protect(part) for part in byte_slices(batch.cast(pa.string()))]
            yield pa.concat_arrays([pa.StructArray.from_arrays(x, ["text", "map"]) for x in done])

    return F.arrow_udf(run, f"text string, map {MAPPING_TYPE}")


def byte_slices(texts: pa.StringArray) -> Iterator[pa.StringArray]:
    """Slices of some ``SLICE_BYTES`` at most, or of one text; one empty slice of no text."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at == 0 or at < len(texts):
        before = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield texts.slice(at, stop - at)
        at = stop


def protect_terms(df: DataFrame, text_col: str, glossary, out_col: str = "protected",
                  mapping_col: str = "term_map") -> DataFrame:
    """Replace glossary terms by ``__TERM_i__`` placeholders.

    Terms are applied longest first, each as a case-insensitive literal
    (no word boundaries) over the text *as rewritten by the earlier terms*;
    ``mapping_col`` lists ``(placeholder, target)`` of the terms that matched,
    in that order. NULL text is ``""``. The glossary (table or list) is ranked and
    written when this is called; texts meet only the terms that occur in them.
    """
    require_columns(df, text_col)
    terms = glossary_terms(glossary, df.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    held = held_terms(terms)
    if held is not None:
        return df.withColumn("_fold", _protected(held)(text)).withColumns(
            {out_col: F.col("_fold.text"), mapping_col: F.col("_fold.map")}).drop("_fold")
    per_text = candidates(df.select(text.alias("_text")), "_text", terms)
    start = F.struct(F.col("text").alias("text"), F.array().cast(MAPPING_TYPE).alias("map"))
    folded = F.aggregate("terms", start, _apply)
    done = per_text.select(F.col("text").alias("_text"), folded.alias("_fold"))
    joined = df.withColumn("_text", text).join(done, "_text", "left")
    return joined.withColumns({
        out_col: F.coalesce(F.col("_fold.text"), F.col("_text")),
        mapping_col: F.coalesce(F.col("_fold.map"), F.array().cast(MAPPING_TYPE))}).drop("_text", "_fold")


def _apply(done, term):
    """One step of the fold: ``term`` over the text that the terms before it left."""
    mark = placeholder(term["position"])
    entry = F.struct(mark.alias("placeholder"), term["target"].alias("target"))
    matched = F.when(F.regexp_like(done["text"], term["pattern"]), F.array_append(done["map"], entry))
    return F.struct(F.regexp_replace(done["text"], term["pattern"], mark).alias("text"),
                    matched.otherwise(done["map"]).alias("map"))


def restore_terms(text, mapping) -> Column:
    """Replace each placeholder by its target term, in mapping order (P10).

    One scan of the text finds the placeholders in it, and only their entries are applied,
    unless a target could form another placeholder: it has an underscore, or it is empty or
    has other letters of placeholders and there are underscores outside whole placeholders.
    """
    text, mapping = F.coalesce(as_col(text), F.lit("")), as_col(mapping)
    marks, targets = mapping["placeholder"], mapping["target"]
    starts = F.array_distinct(F.regexp_extract_all(text, F.lit("__TERM_[0-9]+(?=__)"), F.lit(0)))
    found = F.transform(starts, lambda start: F.concat(start, F.lit("__")))
    # As an array's element, the found ones are computed once and not for every entry.
    here = F.transform(F.array(found), lambda some: F.filter(
        mapping, lambda z: F.array_contains(some, z["placeholder"])))[0]
    other_mark = F.concat(F.lit("|"), F.array_join(marks, "|", "?")).rlike(r"\|(?!__TERM_[0-9]+__(?:\||$))")
    joined = F.array_join(targets, "", "_")
    broken = F.contains(F.regexp_replace(text, "__TERM_[0-9]+__", ""), F.lit("_"))
    forming = (joined.rlike("[_TERM0-9]") | F.array_contains(targets, "")) & (F.contains(joined, F.lit("_")) | broken)

    def applied(entries):
        return F.aggregate(entries, text, lambda acc, z: F.replace(acc, z["placeholder"], z["target"]))

    return F.when(F.size(mapping) == 0, text).when(other_mark | forming, applied(mapping)).otherwise(applied(here))


def mapping_text(mapping) -> Column:
    """Flat text form ``ph=target|ph=target`` of a mapping (for reports/oracles)."""
    return F.array_join(F.transform(as_col(mapping),
                                    lambda z: F.concat(z["placeholder"], F.lit("="), z["target"])), "|")
