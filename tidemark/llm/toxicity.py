"""Toxicity by class-conditional Kneser-Ney models.

A word is spelled: its first LONGEST letters one by one, then the rest (with its end) as one symbol. The history
of a symbol is the whole beginning before it and the class. Counts are continuation counts: n(class, h, x) is the
number of pairs of a text of the class and a different word in it that begins with h x, so repeats within a text
and copies of a whole text count once. With an absolute discount D,

    P(x | class, h) = (max(n(class, h, x) - D, 0) + M(class, h) * S(x | h)) / n(class, h),   M = sum of min(n, D)

and where the class doesn't know h, P = S. The backoff S drops the class from the history and is shared:

    S(x | h) = (max(n(h, x) - d, 0) + m(h) * U(x)) / n(h),   U(x) = number of histories that x follows / all such pairs

A rare expression so keeps most of its probability from the shared counts, and nothing is set to zero. Both classes'
log-likelihoods of a word are sums over its symbols; a history or symbol that neither class has seen is left to S
in both. All counts come from all labelled documents that may be learnt from, in one distributed aggregation.

A document's score compares the two log-likelihoods, normalised by length: their difference over all words, by
the number of words and by its root, and that of its PEAKS most toxic different words (each is a stretch of length
one), as one insult in a long text weighs little in the whole. A logistic curve joins them, fitted on at most
`sample` labelled documents, each scored by models counted without the half of the documents that it belongs to.

The model is broadcast as arrays (16 bytes an expression) if it has at most `model_rows` expressions. Above, the differences of its
most frequent words, HEAD at most, are broadcast instead, and only the documents' other words are joined to the model by a
shuffle (same scores, no size bound).

Defined results: null texts and texts without words have differences of 0 and length 0; ids labelled both
ways or null are not learnt from; every different text of a repeated id is; without labels of both kinds the
score is the smoothed share of label 1.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import batches, inner, materialize, small_batches

DISCOUNT, SHARED_DISCOUNT = 0.75, 0.05
LONGEST = 8
#: Ranks of a text's most toxic different words whose differences are features.
PEAKS = (1, 2, 3, 5, 8)
SAMPLE = 20_000
MODEL_ROWS = 4_000_000
#: Words of a larger model that are broadcast.
HEAD = 2_000_000
#: Labelled ids up to which the ids are broadcast to the documents.
KNOWN_ROWS = 2_000_000
#: Share of a class's texts that either half holds at least where near copies share a half.
LEAST_HALF = 0.2
#: Words whose difference a worker remembers; words that a worker counts before it hands them on.
MEMO = 300_000
HELD = 400_000

_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
#: The models: from all counts, without half 0, without half 1.
KINDS = {"r": ("t0 + t1", "o0 + o1"), "r0": ("t1", "o1"), "r1": ("t0", "o0")}
N_FEATURES = 3 + len(PEAKS)


def words(text: str | None) -> list[bytes]:
    """Runs of lower-cased letters and non-ASCII characters, as UTF-8."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def family(text: str | None) -> str:
    """Digest of the whole text: equal for copies only."""
    return hashlib.blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def passage(text: str | None) -> int:
    """Smallest hash of the text's word 4-grams: mostly equal for near copies, which only share a half for it."""
    own = words(text)
    return min((zlib.crc32(b" ".join(own[i : i + 4])) for i in range(max(1, len(own) - 3))), default=0)


def hash_of(x: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little")


def _families(frames):
    for pdf in frames:
        yield pd.DataFrame({"_row": pdf["_row"], "toxic": pdf["toxic"], "family": [family(t) for t in pdf["text"]], "near": [passage(t) for t in pdf["text"]]})


def _count(frames):
    counts: dict[tuple[int, int], Counter] = {}
    for pdf in frames:
        for text, toxic, half in zip(pdf["text"], pdf["toxic"], pdf["half"]):
            counts.setdefault((toxic, half), Counter()).update(set(words(text)))
            if sum(map(len, counts.values())) >= HELD:
                yield from _counted(counts)
                counts = {}
    yield from _counted(counts)


def _counted(counts: dict):
    for (toxic, half), c in counts.items():
        if c:
            yield pd.DataFrame({"word": [w.decode("utf-8", "replace") for w in c], "toxic": toxic, "half": half, "n": list(c.values())})


def expression_counts(docs: DataFrame) -> DataFrame:
    """e ("word$" or a beginning), h (its history), x (its symbol), and the counts by class (t: toxic, o: ordinary) and half. docs: text, toxic, half."""
    rows = docs.mapInPandas(_count, "word string, toxic int, half int, n long")
    part = lambda c, h: F.sum(F.when((F.col("toxic") == c) & (F.col("half") == h), F.col("n")).otherwise(0))
    sums = [(f"{x}{h}", part(c, h)) for x, c in (("t", 1), ("o", 0)) for h in (0, 1)]
    by_word = rows.groupBy("word").agg(*[s.alias(n) for n, s in sums])
    spelled = by_word.select(F.explode(symbols(F.col("word"))).alias("s"), *[n for n, _ in sums])
    return spelled.groupBy("s.e", "s.h", "s.x").agg(*[F.sum(n).alias(n) for n, _ in sums])


def symbols(word):
    """The spelling of a word: array of (e, h, x)."""
    n = F.least(F.length(word), F.lit(LONGEST))
    letter = lambda k: F.struct(F.substring(word, F.lit(1), k).alias("e"), F.substring(word, F.lit(1), k - 1).alias("h"), F.substring(word, k, F.lit(1)).alias("x"))
    end = F.struct(F.concat(word, F.lit("$")).alias("e"), F.substring(word, F.lit(1), n).alias("h"), F.concat(F.substring(word, n + 1, F.length(word)), F.lit("$")).alias("x"))
    return F.concat(F.transform(F.sequence(F.lit(1), n), letter), F.array(end))


def history_sums(counts: DataFrame) -> DataFrame:
    """h and, for each of KINDS, its counts and discounted masses by class (t, o) and of both (s)."""
    sums = []
    for k, (t, o) in KINDS.items():
        for c, expr, d in (("t", t, DISCOUNT), ("o", o, DISCOUNT), ("s", f"{t} + {o}", SHARED_DISCOUNT)):
            sums += [F.sum(F.expr(expr)).cast("double").alias(f"n{c}_{k}"), F.sum(F.least(F.expr(expr).cast("double"), F.lit(d))).alias(f"m{c}_{k}")]
    return counts.groupBy("h").agg(*sums)


def continuations(counts: DataFrame) -> DataFrame:
    """x and, for each of KINDS, its share U(x) of all pairs of a history and a symbol."""
    seen = {k: F.sum(F.when(F.expr(f"{t} + {o}") > 0, 1).otherwise(0)) for k, (t, o) in KINDS.items()}
    by = materialize(counts.groupBy("x").agg(*[s.alias(f"u_{k}") for k, s in seen.items()]), "continuations")
    whole = by.agg(*[F.sum(f"u_{k}").alias(k) for k in KINDS]).first()
    return by.select("x", *[(F.col(f"u_{k}") / max(1, whole[k] or 0)).alias(f"u_{k}") for k in KINDS])


def conditionals(counts: DataFrame) -> DataFrame:
    """counts with, for each of KINDS, log P(x | toxic, h) and log P(x | ordinary, h) as t_ and o_; both null where neither class has seen h x. counts is read several times."""
    # single letters are many rows' symbol, but there are no more of them than Unicode has
    u = continuations(counts)
    one = F.length("x") == 1
    letters = counts.where(one).join(F.broadcast(u.where(one)), "x")
    rests = counts.where(~one).join(u.where(~one), "x")
    rows = letters.unionByName(rests).join(history_sums(counts), "h")
    out = []
    for k, (t, o) in KINDS.items():
        a, b = F.expr(t).cast("double"), F.expr(o).cast("double")
        n = {c: F.col(f"n{c}_{k}") for c in "tos"}
        m = {c: F.col(f"m{c}_{k}") for c in "tos"}
        s = F.try_divide(F.greatest(a + b - SHARED_DISCOUNT, F.lit(0.0)) + m["s"] * F.col(f"u_{k}"), n["s"])
        p = lambda c, v: F.coalesce(F.try_divide(F.greatest(v - DISCOUNT, F.lit(0.0)) + m[c] * s, n[c]), s)  # noqa: E731, B023
        out += [F.when(a + b > 0, F.log(p(c, v))).alias(f"{c}_{k}") for c, v in (("t", a), ("o", b))]
    return rows.select("e", "h", "x", (F.col("t0") + F.col("t1") + F.col("o0") + F.col("o1")).alias("n"), *out)


def differences(counts: DataFrame) -> DataFrame:
    """e, n (its count) and, for each of KINDS, d_ (log P(x | toxic, h) - log P(x | ordinary, h) of its last symbol; null where unseen) and
    v_ (the same of any unseen symbol after it). A row with e = "" holds v_ of the first letter."""
    own = conditionals(counts).select("e", "n", *[(F.col(f"t_{k}") - F.col(f"o_{k}")).alias(f"d_{k}") for k in KINDS])
    share = lambda c, k: F.coalesce(F.log(F.try_divide(f"m{c}_{k}", f"n{c}_{k}")), F.lit(0.0))
    after = history_sums(counts).select(F.col("h").alias("e"), *[(share("t", k) - share("o", k)).alias(f"v_{k}") for k in KINDS])
    return own.join(after, "e", "full")


def spellings(own: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the beginnings of 1 to LONGEST letters (0 where the word is shorter) and of the whole, a row a word."""
    decoded = [w.decode("utf-8", "replace") for w in own]
    sizes = np.fromiter(map(len, decoded), np.int64, len(own))
    codes = np.array([w[:LONGEST] for w in decoded] or [""], dtype=f"U{LONGEST}").view(np.uint32).reshape(-1, LONGEST)[: len(own)].astype(np.uint64)
    heads = np.zeros((len(own), LONGEST), np.uint64)
    h = np.full(len(own), 0x243F6A8885A308D3, np.uint64)
    for k in range(LONGEST):
        h = _mix((h + codes[:, k]) * np.uint64(0x9E3779B97F4A7C15))
        heads[:, k] = np.where(sizes > k, h, 0)
    whole = np.fromiter((hash_of(w) for w in own), np.uint64, len(own))
    return heads, _mix(whole * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def _keys(frames):
    """Hash of every expression, so that no text reaches the driver."""
    for pdf in frames:
        e = [x.encode("utf-8") for x in pdf["e"]]
        whole = np.array([x.endswith(b"$") for x in e], bool)
        heads, ends = spellings([x.removesuffix(b"$") for x in e])
        sizes = np.array([len(x) for x in pdf["e"]], np.int64)
        last = heads[np.arange(len(e)), np.clip(sizes - 1, 0, LONGEST - 1)]
        out = pdf.drop(columns="e")
        out.insert(0, "e", np.where(whole, ends, last).view(np.int64))
        yield out.astype({"d": "float32", "v": "float32"})


class Differences:
    """The difference of a word's two log-likelihoods, by a table of hashed expressions; a bounded memory of the words seen."""

    def __init__(self, keys: np.ndarray, own: np.ndarray, after: np.ndarray, first: float):
        order = np.argsort(keys)
        self.keys, self.own, self.after, self.first, self.memo = keys[order], own[order], after[order], first, {}

    def _find(self, h: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, at, -1)

    def looked_up(self, own: list[bytes]) -> np.ndarray:
        heads, ends = spellings(own)
        total, after, live = np.zeros(len(own)), np.full(len(own), self.first), np.ones(len(own), bool)
        for k in range(LONGEST + 1):
            here = (live & (heads[:, k] != 0)) if k < LONGEST else live
            rows = np.flatnonzero(here)
            at = self._find(heads[rows, k] if k < LONGEST else ends[rows])
            d = np.where(at >= 0, self.own[at], np.nan) if len(self.keys) else np.full(len(rows), np.nan)
            known = ~np.isnan(d)
            total[rows] += np.where(known, d, after[rows])
            live[rows[~known]] = False
            if k < LONGEST:
                v = self.after[at[known]]
                after[rows[known]] = np.where(np.isnan(v), 0.0, v)
        return total

    def of(self, flat: list[bytes]) -> np.ndarray:
        new = [w for w in dict.fromkeys(flat) if w not in self.memo]
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = list(dict.fromkeys(flat))
        if new:
            self.memo.update(zip(new, self.looked_up(new).tolist()))
        return np.fromiter(map(self.memo.__getitem__, flat), np.float64, len(flat))


def _scorer(shared):
    @F.pandas_udf("llr double, n long, peaks array<double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        counts = [Counter(words(t)) for t in texts]
        sizes = np.array([len(c) for c in counts], np.int64)
        flat = [w for c in counts for w in c]
        times = np.fromiter((n for c in counts for n in c.values()), np.float64, len(flat))
        d = shared.value.of(flat)
        total = np.bincount(np.repeat(np.arange(len(counts)), sizes), d * times, len(counts)) if flat else np.zeros(len(counts))
        peaks, at = [], 0
        for n in sizes.tolist():
            part = d[at : at + n]
            best = -np.sort(-(part if n <= PEAKS[-1] else np.partition(part, n - PEAKS[-1])[-PEAKS[-1] :]))
            peaks.append([float(best[k - 1]) if n >= k else 0.0 for k in PEAKS])
            at += n
        return pd.DataFrame({"llr": total, "n": [sum(c.values()) for c in counts], "peaks": peaks})

    return run


def _hashed(frames):
    for pdf in frames:
        yield pd.DataFrame({"e": np.array([hash_of(w.encode("utf-8")) for w in pdf["word"]], np.uint64).view(np.int64), "d": pdf["d"]})


class Head:
    """Differences of frequent words, by hash; NaN for other words."""

    def __init__(self, keys: np.ndarray, d: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.d = keys[order], d[order]

    def of(self, words: list[bytes]) -> np.ndarray:
        h = np.fromiter((hash_of(w) for w in words), np.uint64, len(words))
        if not len(self.keys):
            return np.full(len(words), np.nan)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, self.d[at], np.nan)


def _split_words(shared):
    """For each row the sum and the best of its frequent words (word is null, c: all its words), and a row for each other word."""

    def run(frames):
        head = shared.value
        for pdf in frames:
            out: list[tuple] = []
            for row, text in zip(pdf["_row"].tolist(), pdf["text"]):
                counts = Counter(words(text))
                if not counts:
                    continue
                own, times = list(counts), np.fromiter(counts.values(), np.float64, len(counts))
                d = head.of(own)
                known = ~np.isnan(d)
                best = -np.sort(-d[known])[: PEAKS[-1]]
                out.append((row, None, sum(counts.values()), float((d[known] * times[known]).sum()), best.tolist()))
                out += [(row, own[i].decode("utf-8", "replace"), counts[own[i]], 0.0, []) for i in np.flatnonzero(~known).tolist()]
            yield pd.DataFrame(out, columns=["_row", "word", "c", "d", "best"])

    return run


class KneserNey:
    """Differences of the two models and the logistic curve over normalised ones."""

    def __init__(self, table: DataFrame, curve: np.ndarray, model_rows: int):
        self.table, self.curve, self.model_rows = table, curve, model_rows
        self._shared: dict[str, object] = {}

    def first(self, kind: str) -> float:
        """The difference of a first letter that neither class has seen."""
        row = self.table.where("e = ''").select(f"v_{kind}").first()
        return float(row[0]) if row and row[0] is not None else 0.0

    def shared(self, kind: str):
        if kind not in self._shared:
            rows = self.table.where("e <> ''").select("e", F.col(f"d_{kind}").alias("d"), F.col(f"v_{kind}").alias("v"))
            got = rows.mapInPandas(_keys, "e long, d float, v float").toArrow()
            arrays = [got["e"].to_numpy().view(np.uint64), got["d"].to_numpy().astype(np.float32), got["v"].to_numpy().astype(np.float32)]
            self._shared[kind] = self.table.sparkSession.sparkContext.broadcast(Differences(*arrays, self.first(kind)))
        return self._shared[kind]

    def release(self, kind: str) -> None:
        if kind in self._shared:
            self._shared.pop(kind).unpersist()

    def differences(self, docs: DataFrame, kind: str = "r", text_col: str = "text") -> DataFrame:
        """docs with a struct inner("llr"): llr (difference of log-likelihoods), n (words), peaks (differences at PEAKS)."""
        if self.table.count() <= self.model_rows:
            small_batches(docs.sparkSession)
            return docs.withColumn(inner("llr"), _scorer(self.shared(kind))(F.col(text_col)))
        return self._joined(docs, kind, text_col)

    def of_words(self, words: DataFrame, kind: str) -> DataFrame:
        """word and d, its difference, of words that begin like one of the model's. words: word, each once."""
        model = self.table.select("e", F.col(f"d_{kind}").alias("d"), F.col(f"v_{kind}").alias("v")).where("e <> ''")
        parts = words.select("word", F.posexplode(symbols(F.col("word"))).alias("k", "s")).select("word", "k", "s.e").join(model, "e")
        known = parts.where("d is not null").groupBy("word").agg(F.sum("d").alias("d"), F.count(F.lit(1)).alias("k"), F.max_by(F.coalesce("v", F.lit(0.0)), "k").alias("v"))
        length = F.least(F.length("word"), F.lit(LONGEST)) + 1
        return known.select("word", (F.col("d") + F.when(F.col("k") < length, F.col("v")).otherwise(0.0)).alias("d"))

    def head(self, kind: str) -> Head:
        """The most frequent whole words, HEAD at most: those of a count that no more words reach."""
        whole = self.table.where(F.col("e").endswith("$"))
        have, least = 0, None
        for r in whole.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():  # a row a count that occurs
            have += r["count"]
            if have > HEAD:
                break
            least = r["n"]
        if least is None:
            return Head(np.zeros(0, np.uint64), np.zeros(0))
        frequent = whole.where(F.col("n") >= least).select(F.expr("substring(e, 1, length(e) - 1)").alias("word"))
        got = self.of_words(frequent, kind).mapInPandas(_hashed, "e long, d double").toArrow()
        return Head(got["e"].to_numpy().view(np.uint64), got["d"].to_numpy())

    def _joined(self, docs: DataFrame, kind: str, text_col: str) -> DataFrame:
        row = inner("row")
        rows = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "toxicity-rows")
        sent = docs.sparkSession.sparkContext.broadcast(self.head(kind))
        used = rows.select(F.col(row).alias("_row"), F.col(text_col).alias("text")).mapInPandas(_split_words(sent), "_row long, word string, c long, d double, best array<double>")
        with batches(docs.sparkSession):
            used = materialize(used, "toxicity-words")
        sent.unpersist()
        others = used.where("word is not null").select("_row", "word", "c")
        by_word = self.of_words(others.select("word").distinct(), kind)
        each = others.join(by_word, "word", "left").withColumn("d", F.coalesce("d", F.lit(self.first(kind))))
        sums = each.groupBy("_row").agg(F.sum(F.col("c") * F.col("d")).alias("more"))
        ranked = each.withColumn("rank", F.row_number().over(Window.partitionBy("_row").orderBy(F.desc("d")))).where(F.col("rank") <= PEAKS[-1])
        top = ranked.groupBy("_row").agg(F.collect_list("d").alias("top"))
        whole = used.where("word is null").join(sums, "_row", "left").join(top, "_row", "left")
        best = F.sort_array(F.concat("best", F.coalesce("top", F.array().cast("array<double>"))), asc=False)
        found = whole.select(F.col("_row").alias(row), (F.col("d") + F.coalesce("more", F.lit(0.0))).alias("llr"), F.col("c").alias("n"), best.alias("best"))
        peaks = F.array(*[F.coalesce(F.get("best", F.lit(k - 1)), F.lit(0.0)) for k in PEAKS])
        found = found.select(row, F.struct("llr", "n", peaks.alias("peaks")).alias(inner("llr")))
        none = F.struct(F.lit(0.0).alias("llr"), F.lit(0).cast("long").alias("n"), F.array(*[F.lit(0.0)] * len(PEAKS)).alias("peaks"))
        return rows.join(found, row, "left").withColumn(inner("llr"), F.coalesce(F.col(inner("llr")), none)).drop(row)

    def score(self, docs: DataFrame, out: str = "score", text_col: str = "text") -> DataFrame:
        """docs with the probability of label 1 of every whole text."""
        rows = self.differences(docs, "r", text_col)
        z = F.lit(float(self.curve[0]))
        for w, c in zip(self.curve[1:], features(F.col(inner("llr")))):
            z = z + float(w) * c
        return rows.withColumn(out, 1 / (1 + F.exp(-F.greatest(F.lit(-40.0), F.least(F.lit(40.0), z))))).drop(inner("llr"))


def features(of) -> list:
    """Length-normalised forms of the difference: a word, a root of a word, the most toxic words, and the length's logarithm."""
    size = F.greatest(of["n"], F.lit(1)).cast("double")
    return [of["llr"] / size, of["llr"] / F.sqrt(size) / 4, *[of["peaks"][i] / 5 for i in range(len(PEAKS))], F.log(size) / 5]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Intercept and weights by Newton steps."""
    x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        hessian = x.T @ (x * (p * (1 - p))[:, None]) / len(x) + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) / len(x) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return w


def distinct_texts(texts: DataFrame) -> DataFrame:
    """_row, text, toxic, half and _at (place in the sample) of one row of each text in each class. texts: a stored table of _row, text, toxic.

    Near copies share a half; where that leaves a half less than LEAST_HALF of a class, as a passage in most texts may, halves are dealt by text.
    """
    families = texts.mapInPandas(_families, "_row long, toxic int, family string, near long")
    heads = families.groupBy("family", "toxic").agg(F.min(F.struct("_row", "near")).alias("head"))
    half = lambda c: F.pmod(F.xxhash64(c), F.lit(2)).cast("int")
    heads = materialize(heads.select("head._row", half("head.near").alias("near"), half("family").alias("own"), F.xxhash64("family", "toxic", F.lit(7)).alias("_at"), F.col("toxic").alias("_c")), "families")
    shares = [r["share"] for r in heads.groupBy("_c").agg(F.avg("near").alias("share")).collect()]
    dealt = "near" if all(LEAST_HALF <= x <= 1 - LEAST_HALF for x in shares) else "own"
    known = heads.count() <= KNOWN_ROWS
    heads = heads.select("_row", F.col(dealt).alias("half"), "_at")
    return texts.join(F.broadcast(heads) if known else heads, "_row")


def learn(docs: DataFrame, labels: DataFrame, *args, **kwargs) -> KneserNey:
    """Count both models over all labelled documents given, and fit the curve. labels: id and label (0 or 1). Parameters: those of _learn()."""
    with batches(docs.sparkSession):
        return _learn(docs, labels, *args, **kwargs)


def _learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, model_rows: int = MODEL_ROWS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label") -> KneserNey:
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("toxic"), F.max(label_col).alias("_z"))
    known = materialize(known.where("toxic = _z").select("_id", F.col("toxic").cast("int")), "known")
    known = F.broadcast(known) if known.count() <= KNOWN_ROWS else known
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(known, "_id")
    texts = materialize(texts.select(F.monotonically_increasing_id().alias("_row"), "text", "toxic"), "labelled")
    one = materialize(distinct_texts(texts), "distinct")
    counts = materialize(expression_counts(spread(one.select("text", "toxic", "half"))), "expressions")
    model = KneserNey(materialize(differences(counts), "differences"), np.zeros(N_FEATURES + 1), model_rows)
    chosen = one.select("_row", "_at").orderBy("_at", "_row").limit(sample).select("_row")
    few = materialize(one.join(F.broadcast(chosen), "_row").select("text", "toxic", "half"), "curve")
    parts = []
    for half in (0, 1):
        rows = model.differences(spread(few.where(F.col("half") == half)), f"r{half}")
        parts.append(rows.select("toxic", *[c.alias(f"x{i}") for i, c in enumerate(features(F.col(inner("llr"))))]).toArrow().to_pandas())
        model.release(f"r{half}")
    got = pd.concat(parts)
    y = got["toxic"].to_numpy(np.float64)
    if len(y) == 0 or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        model.curve = np.r_[np.log(share / (1 - share)), np.zeros(N_FEATURES)]
    else:
        model.curve = logistic(got[[f"x{i}" for i in range(N_FEATURES)]].to_numpy(np.float64), y)
    return model


def spread(rows: DataFrame) -> DataFrame:
    """rows dealt evenly over as many partitions as a shuffle has, however their files are cut."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
