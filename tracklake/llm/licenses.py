"""License scan by a positional index of rare license words.

1. A pass over all texts counts in how many documents each word of a mandatory phrase stands.
2. The index holds the places (template, place) of these words in the texts of ``license_texts``. A file looks up its
   own words by falling inverse document frequency, for a template until two of one phrase are looked up,
   and for none that lacks a phrase's word.
3. Postings are intersected by relative position: a shift (word place minus template place) on which two
   different words agree is an alignment. A file that holds a phrase has its two words on one shift, so none is missed.
4. From the alignment the template is laid over the file word by word, both ways; after up to ``DRIFT`` words put in
   or left out it goes on where three words agree. It counts if ``COVERAGE`` of the template is there and
   its mandatory phrases stand in the span laid over.

The texts and the index are fixed and small; document counts come back as one number per word. Null
texts count as empty; empty texts have no words, no labels and score 0; repeated rows are each scanned, also those with
a null doc_id. Several templates may match one file: all their labels are given, and the best score.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import exact, table
from tracklake.llm.license_texts import TEMPLATES

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Phrases whose places are counted, with their labels. Fixed values.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Share of a template that must be there; words put in or left out at one place.
COVERAGE = 0.6
DRIFT = 16
_DRIFTS = [d for n in range(1, DRIFT + 1) for d in (n, -n)]


def _split(text: str) -> list[bytes]:
    return _WORD.findall(text.lower().encode())


_SPLIT = [_split(text) for _, text, _ in TEMPLATES]
_PHRASES = [[_split(p) for p in phrases] for *_, phrases in TEMPLATES]
_NEEDED = [frozenset(w for p in phrases for w in p) for phrases in _PHRASES]
VOCABULARY = sorted(frozenset().union(*_NEEDED))
_BASE = [(_split(p), label) for p, label in BASE]


def _words(text) -> list[bytes]:
    return _WORD.findall((text.as_py() or b"").lower())


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = frozenset(VOCABULARY)
    for batch in batches:
        seen = defaultdict(int)
        for text in batch.column(0).cast(pa.large_binary()):
            for w in known.intersection(_words(text)):
                seen[w] += 1
        yield pa.RecordBatch.from_pydict({"word": [w.decode() for w in seen], "docs": list(seen.values())})


def _places(words: list[bytes], phrase: list[bytes], at: dict[bytes, list[int]]) -> list[int]:
    n = len(phrase)
    return [i for i in at.get(phrase[0], ()) if words[i : i + n] == phrase]


def _lay(words: list[bytes], template: list[bytes], i: int, j: int) -> tuple[int, int, int]:
    """Template words found, first and last word of the span, from template word ``j`` on ``words[i]`` both ways; 0 found if too few."""
    found, missed, ends = 1, 0, []
    for step, stop in ((1, len(template)), (-1, -1)):
        at, last, k = i, i, j + step
        while k != stop:
            at += step
            if 0 <= at < len(words) and words[at] == template[k]:
                found, last = found + 1, at
            else:
                lo, hi = (0, 3) if step > 0 else (-2, 1)
                ahead = template[k + lo : k + hi] if k + lo >= 0 else []
                moved = next((d for d in _DRIFTS if (at + d - last) * step > 0 and at + d + lo >= 0 and words[at + d + lo : at + d + hi] == ahead), None) if len(ahead) == 3 else None
                if moved is None:
                    missed += 1
                    if len(template) - missed < COVERAGE * len(template):
                        return 0, i, i
                else:
                    at += moved
                    found, last = found + 1, at
            k += step
        ends.append(last)
    return found, ends[1], ends[0]


def _matches(words: list[bytes], t: int, i: int, j: int) -> float:
    """Share of template ``t`` found where its word ``j`` lies on ``words[i]``; 0 if it doesn't count."""
    found, first, last = _lay(words, _SPLIT[t], i, j)
    if found < COVERAGE * len(_SPLIT[t]):
        return 0.0
    span = words[first : last + 1]
    there = all(any(span[k : k + len(p)] == p for k, w in enumerate(span) if w == p[0]) for p in _PHRASES[t])
    return found / len(_SPLIT[t]) if there else 0.0


def _scanner(weight: dict[bytes, float]):
    index, phrases_of, templates_of = defaultdict(list), defaultdict(set), defaultdict(set)
    for t, words in enumerate(_SPLIT):
        for j, w in enumerate(words):
            if w in _NEEDED[t]:
                index[w].append((t, j))
                templates_of[w].add(t)
        for p, phrase in enumerate(_PHRASES[t]):
            for w in phrase:
                phrases_of[t, w].add(p)
    rank = {w: n for n, w in enumerate(sorted(VOCABULARY, key=lambda w: (-weight[w], w)))}
    known = frozenset(VOCABULARY)

    def look_up(held: frozenset[bytes]) -> dict[bytes, set[int]]:
        """The file's words to look up, each with the templates that it is looked up for."""
        able = [t for t, needed in enumerate(_NEEDED) if needed <= held]
        wanted, open_ = {}, {t: [0] * len(_PHRASES[t]) for t in able}
        for w in sorted(held, key=rank.__getitem__):
            if not open_:
                break
            if of := templates_of[w] & open_.keys():
                wanted[w] = of
            for t in of:
                for p in phrases_of[t, w]:
                    open_[t][p] += 1
                if 2 in open_[t]:
                    del open_[t]
        return wanted

    def scan(words: list[bytes]) -> tuple[list[int], set[str], set[str], float, int]:
        every = frozenset(words)
        wanted = look_up(known & every)
        phrases = [(p, label) for p, label in _BASE if every.issuperset(p)]
        at = defaultdict(list)
        if wanted or phrases:
            kept = wanted.keys() | {p[0] for p, _ in phrases}
            for i, w in enumerate(words):
                if w in kept:
                    at[w].append(i)
        base = {label: found for phrase, label in phrases if (found := _places(words, phrase, at))}
        labels, score = set(base), 1.0 if base else 0.0
        one, aligned = {}, {}
        for w, of in wanted.items():
            for t, j in index[w]:
                if t in of:
                    for i in at[w]:
                        if one.setdefault((t, i - j), w) != w:
                            aligned[t, i - j] = i, j
        for (t, _), (i, j) in aligned.items():
            if like := _matches(words, t, i, j):
                labels.add(TEMPLATES[t][0])
                score = max(score, like)
        return sorted({i for found in base.values() for i in found}), set(base), labels, score, sum(map(len, base.values()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1).cast(pa.large_binary()):
                words = _words(text)
                starts, base, labels, score, n_base = scan(words)
                first, last = (starts[0], starts[-1]) if starts else (None, None)
                rows.append((len(words), n_base, first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return run


def scan_licenses(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row of ``docs`` (doc_id, text)."""
    docs = exact(docs, "doc_id", "text")
    counted = docs.select("text").mapInArrow(_frequencies, "word string, docs long").groupBy("word").agg(F.sum("docs").alias("docs"))
    docs_with = {r["word"].encode(): r["docs"] for r in counted.collect()}  # a row per template word
    weight = {w: -math.log(1 + docs_with.get(w, 0)) for w in VOCABULARY}
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return docs.mapInArrow(_scanner(weight), schema)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(spark, table(spark, sf_dir, "documents"))
