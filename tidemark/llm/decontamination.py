"""Benchmark decontamination by a distributed positional inverted index.

build_index() stores the postings of all training tokens: the corpus is dealt into segments of about
SEGMENT bytes of whole documents, and a segment's row holds its terms and, by term, the ordered positions.
One position between two documents stays empty, so no phrase spans them. probe() takes phrases to every
segment: phrases with a term that the segment lacks are out; for the rest the list of the rarest term is
shifted by that term's offset and intersected with the shifted lists of the other terms, rarest first.
near() gives proximity matches: all terms of a phrase, in any order, within a few words more than its length.

The phrases are broadcast in chunks of items that hold at most about CHUNK words together; more items
take more passes over the stored index, and their hits are merged by document.

Defined results: null texts and texts without words have 0 words and no hits; items without words or without
an id match nothing; repeated item rows count once by their id, repeated documents each get their row.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, materialize

SEGMENT = 4 << 20
CHUNK = 2_000_000
#: Starts that are intersected at once.
STARTS = 1 << 20

_fold = bytearray(range(256))
for _b in range(128):
    _c = chr(_b)
    _fold[_b] = ord(_c.lower()) if _c.isalnum() else 0x20
FOLD = bytes(_fold)
GAP = b"\x01"


def words(text: str | None) -> list[bytes]:
    """Runs of 0-9, a-z and all characters above 7F, A-Z in lower case, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


def segment(ids: list, texts: list[bytes]) -> dict:
    """The index of some documents; texts are folded."""
    tokens = (b" " + GAP + b" ").join([*texts, b""]).split()
    vocabulary = dict.fromkeys(tokens)
    vocabulary.pop(GAP, None)
    number = {t: i for i, t in enumerate(vocabulary)}
    number[GAP] = len(number)
    at = np.fromiter(map(number.__getitem__, tokens), np.int32, len(tokens))
    order = np.argsort(at, kind="stable").astype(np.int32)
    counts = np.bincount(at, minlength=len(number)).astype(np.int32)
    gaps = order[len(order) - counts[-1] :]
    order, counts = order[: len(order) - counts[-1]], counts[:-1]
    steps = np.diff(order, prepend=np.int32(0)).astype(np.int32)
    first = np.cumsum(counts) - counts
    steps[first] = order[first]
    starts = np.r_[0, gaps[:-1] + 1].astype(np.int32)
    return {
        "segment": uuid.uuid4().hex,
        "ids": np.array([0 if x is None else x for x in ids], np.int64).tobytes(),
        "known": np.array([x is not None for x in ids], np.int8).tobytes(),
        "starts": starts.tobytes(),
        "ends": gaps.astype(np.int32).tobytes(),
        "terms": b"\n".join(vocabulary),
        "counts": counts.tobytes(),
        "steps": steps.tobytes(),
    }


INDEX = "segment string, ids binary, known binary, starts binary, ends binary, terms binary, counts binary, steps binary"


def _segments(frames):
    ids, texts, held = [], [], 0
    for pdf in frames:
        for i, t in zip(pdf["id"].tolist(), pdf["text"].tolist()):
            ids.append(None if i is None or i != i else int(i))
            texts.append(t.encode("utf-8", "surrogatepass").translate(FOLD) if t else b"")
            held += len(texts[-1]) + 64
            if held >= SEGMENT:
                yield pd.DataFrame([segment(ids, texts)])
                ids, texts, held = [], [], 0
    if ids:
        yield pd.DataFrame([segment(ids, texts)])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Segments of the positional index of whole texts, stored in the shared folder."""
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    with batches(docs.sparkSession):
        return materialize(rows.mapInPandas(_segments, INDEX), "index")


class Segment:
    """An index row, opened."""

    def __init__(self, row):
        self.ids = np.frombuffer(row.ids, np.int64)
        self.known = np.frombuffer(row.known, np.int8)
        self.starts = np.frombuffer(row.starts, np.int32).astype(np.int64)
        self.ends = np.frombuffer(row.ends, np.int32).astype(np.int64)
        self.counts = np.frombuffer(row.counts, np.int32).astype(np.int64)
        self.offsets = np.r_[0, np.cumsum(self.counts)]
        self.number = {t: i for i, t in enumerate(row.terms.split(b"\n"))} if row.terms else {}
        steps = np.frombuffer(row.steps, np.int32).astype(np.int64)
        total = np.cumsum(steps)
        first = self.offsets[:-1]
        self.postings = total - np.repeat((total[first] - steps[first]) if len(first) else first, self.counts)
        self.width = int(self.ends[-1]) + 1 if len(self.ends) else 1
        #: term * width + position: ascending, so one search intersects any number of shifted lists
        self.keys = np.repeat(np.arange(len(self.counts)), self.counts) * self.width + self.postings

    def holds(self, term: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = term * self.width + position
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return (self.keys[at] == key) & (position >= 0) & (position < self.width)

    def matches(self, phrases: np.ndarray):
        """phrases: n x length of term numbers. (phrase, start) of every exact occurrence."""
        n, length = phrases.shape
        order = np.argsort(self.counts[phrases], axis=1, kind="stable")
        rare = phrases[np.arange(n), order[:, 0]]
        sizes = self.counts[rare]
        out = []
        at = 0
        while at < n:
            to = max(at + 1, int(np.searchsorted(np.cumsum(sizes[at:]), STARTS, side="right")) + at)
            size = sizes[at:to]
            phrase = np.repeat(np.arange(at, to), size)
            inner = np.arange(len(phrase)) - np.repeat(np.cumsum(size) - size, size)
            start = self.postings[np.repeat(self.offsets[rare[at:to]], size) + inner] - order[phrase, 0]
            for j in range(1, length):
                offset = order[phrase, j]
                fine = self.holds(phrases[phrase, offset], start + offset)
                phrase, start = phrase[fine], start[fine]
                if not len(phrase):
                    break
            out.append((phrase, start))
            at = to
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return [np.concatenate(x) for x in zip(*out)]


def windows(items: list[tuple[str, str]], size: int) -> dict:
    """terms, and by phrase length an array of term numbers and the item of each row."""
    number: dict[bytes, int] = {}
    by: dict[int, tuple[list, list]] = {}
    names = []
    for name, text in items:
        terms = [number.setdefault(w, len(number)) for w in words(text)]
        if not terms:
            continue
        names.append(name)
        length = min(size, len(terms))
        rows, owner = by.setdefault(length, ([], []))
        for i in range(len(terms) - length + 1):
            rows.append(terms[i : i + length])
            owner.append(len(names) - 1)
    return {"terms": list(number), "names": names, "by": {k: (np.array(r, np.int64), np.array(o, np.int64)) for k, (r, o) in by.items()}}


def _probe(chunk):
    def run(frames):
        asked = chunk.value
        for pdf in frames:
            for row in pdf.itertuples(index=False):
                seg = Segment(row)
                local = np.array([seg.number.get(t, -1) for t in asked["terms"]], np.int64)
                cover = np.zeros(seg.width + 1, np.int32)
                pairs = []
                for length, (phrases, owner) in asked["by"].items():
                    here = local[phrases]
                    able = np.flatnonzero((here >= 0).all(axis=1))
                    if not len(able):
                        continue
                    phrase, start = seg.matches(here[able])
                    np.add.at(cover, start, 1)
                    np.add.at(cover, start + length, -1)
                    doc = np.searchsorted(seg.ends, start, side="right")
                    pairs.append(np.unique(doc * len(asked["names"]) + owner[able[phrase]]))
                covered = np.r_[0, np.cumsum(np.cumsum(cover) > 0)]
                hits = covered[seg.ends] - covered[seg.starts]
                found: dict[int, list[str]] = {}
                for p in np.unique(np.concatenate(pairs)).tolist() if pairs else []:
                    found.setdefault(p // len(asked["names"]), []).append(asked["names"][p % len(asked["names"])])
                spans = {}
                edge = np.diff(np.r_[0, (np.cumsum(cover) > 0).astype(np.int8), 0])
                for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
                    d = int(np.searchsorted(seg.ends, a, side="right"))
                    spans.setdefault(d, []).append({"from": int(a - seg.starts[d]), "to": int(b - seg.starts[d])})
                n = len(seg.ids)
                yield pd.DataFrame(
                    {
                        "doc_id": pd.Series(seg.ids.tolist(), dtype="Int64").where(pd.Series(seg.known.astype(bool)), pd.NA),
                        "n_words": seg.ends - seg.starts,
                        "n_hit": hits,
                        "items": [sorted(set(found.get(d, []))) for d in range(n)],
                        "spans": [spans.get(d, []) for d in range(n)],
                        "place": [f"{row.segment}:{d}" for d in range(n)],
                    }
                )

    return run


FOUND = "doc_id long, n_words long, n_hit long, items array<string>, spans array<struct<from: long, to: long>>, place string"


def probe(index: DataFrame, items: DataFrame, size: int = 10, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, items (ids as sorted strings), spans (covered words, end exclusive) for every document."""
    spark = index.sparkSession
    rows = items.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("item is not null and text is not null")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    chunks = max(1, -(-total // (6 * CHUNK)))
    parts = []
    for i in range(chunks):
        own = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(chunks)) == i) if chunks > 1 else rows
        asked = spark.sparkContext.broadcast(windows([(r[0], r[1]) for r in own.collect()], size))
        with batches(spark, 1, "64m"):  # a segment at a time
            parts.append(materialize(index.mapInPandas(_probe(asked), FOUND), "hits"))
    if chunks == 1:
        return parts[0].drop("place")
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    merged = every.groupBy("place", "doc_id").agg(F.max("n_words").alias("n_words"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.flatten(F.collect_list("spans")).alias("spans"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["from"], s["to"] - 1)))))
    return merged.select("doc_id", "n_words", covered.cast("long").alias("n_hit"), "items", "spans")


def near_spans(seg: Segment, terms: list[int], width: int) -> list[tuple[int, int]]:
    """Shortest spans (end exclusive) of at most `width` positions that hold all the terms, one for each place of the rarest."""
    rare = min(terms, key=lambda t: seg.counts[t])
    lists = {t: seg.postings[seg.offsets[t] : seg.offsets[t + 1]] for t in terms}
    out = []
    for p in lists[rare].tolist():
        doc = int(np.searchsorted(seg.ends, p, side="right"))
        low, high = max(int(seg.starts[doc]), p - width + 1), min(int(seg.ends[doc]), p + width)
        here = sorted((int(x), t) for t, list_ in lists.items() for x in list_[np.searchsorted(list_, low) : np.searchsorted(list_, high)])
        seen: dict[int, int] = {}
        best = None
        for x, t in here:
            seen[t] = x
            if len(seen) == len(lists) and min(seen.values()) <= p <= x:
                a = min(seen.values())
                if x + 1 - a <= width and (best is None or x - a < best[1] - 1 - best[0]):
                    best = (a, x + 1)
        if best and (not out or out[-1] != best):
            out.append(best)
    return out


def near(index: DataFrame, phrases: list[tuple[str, str]], slop: int = 5) -> DataFrame:
    """Proximity matches of (name, text) phrases: doc_id (null where the document has none), name, and the span of words in the document."""
    asked = [(name, sorted(set(words(text))), len(words(text))) for name, text in phrases]

    def run(frames):
        for pdf in frames:
            for row in pdf.itertuples(index=False):
                seg = Segment(row)
                got = []
                for name, terms, length in asked:
                    if terms and all(t in seg.number for t in terms):
                        for a, b in near_spans(seg, [seg.number[t] for t in terms], length + slop):
                            d = int(np.searchsorted(seg.ends, a, side="right"))
                            got.append((int(seg.ids[d]) if seg.known[d] else None, name, a - int(seg.starts[d]), b - int(seg.starts[d])))
                yield pd.DataFrame(got, columns=["doc_id", "name", "from", "to"]).astype({"doc_id": "Int64"})

    with batches(index.sparkSession, 1, "64m"):
        return materialize(index.mapInPandas(run, "doc_id long, name string, from long, to long"), "near")


def decontaminate(docs: DataFrame, items: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return probe(build_index(docs, id_col, text_col), items, size)
