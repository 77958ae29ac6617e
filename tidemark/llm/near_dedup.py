"""Near-duplicates by a chosen-path set similarity join.

Texts with equal shingle sets form a class. Every class has `COORDINATES` minwise tokens, one bit of each as a
sketch. A tree branches its documents by minwise tokens it chooses by hash, 1 / similarity of them expected at
a node: those that share a chosen token share a child. Small nodes are compared exhaustively by sketch, large
ones branch again; `trees` independent trees repeat this, so that a pair at the threshold is missed only
where all trees part it.

Only links that join something are looked for. First every node's members are held against its hub, the
member nearest to the majority of their sketches, which joins most of a large group of near copies by as many
pairs as it has members. Nodes whose members are all joined by then drop out; in the others only pairs across
components are compared. A large node in which few members are outside its largest component is compared
as those few against all, in blocks; other large nodes branch on, up to `DEPTH`, after which they are
compared in blocks, too. What the sketches find is handed on as spanning trees, not as all pairs; their
components are families of texts that may be linked. A family's texts come together (large ones as those outside
the largest component against blocks of all, or in pairs of blocks), all its pairs across components that the
sketches allow are decided by exact intersections of full shingle sets, and the links that join something are kept.
Components are found by moving keys along their links.

Defined results: null or wordless texts have an empty set and are linked with nothing; repeated rows and equal
texts share a component; rows without an id take the component of their class, but lend it no id (null where
no row of the class has one); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, materialize

COORDINATES = 128
TREES = 8
#: Members of a node that are compared exhaustively.
SMALL = 512
#: Members outside a large node's largest component up to which they are compared with all.
OTHERS = 2048
DEPTH = 10
#: Members of a node above which its hub is chosen by majority.
CENTRAL = 8
#: Rows of nodes or families, and shingles of families, that are held at once, about.
HELD_ROWS, HELD_SHINGLES = 1_000, 4_000_000
#: Rows whose pairs with all others of a tile are worked out at once, and shingles that are intersected at once, about.
BLOCK, RANGE = 128, 500_000
#: Rows of a node above which it may go to its rows by broadcast, and how many such nodes there are at most.
HOT_ROWS, HOT_NODES = 4_096, 100_000
#: Members of a hub whose texts are held against one copy of the hub's.
SALTED = 32
#: Class ids up to which they are broadcast to the documents when texts are fetched.
FETCH_ROWS = 2_000_000
MEMO = 400_000
#: Standard deviations by which a sketch may understate a pair: a pair at 0.80 differs in more bits with a chance of about 1e-7.
SLACK = 5.9

_rng = np.random.default_rng(20240229)
_ODD = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
# A-Z in lower case; words end at the six ASCII white spaces, which bytes.split() knows
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_memo: dict[bytes, int] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER).split() if text else []


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's k-word shingles; fewer words make one shingle."""
    own = words(text)
    if not own:
        return np.zeros(0, np.uint64)
    if len(_memo) > MEMO:
        _memo.clear()
    for w in own:
        if w not in _memo:
            _memo[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
    w = np.fromiter(map(_memo.__getitem__, own), np.uint64, len(own))
    size = min(k, len(w))
    n = len(w) - size + 1
    h = np.full(n, size, np.uint64)
    for i in range(size):
        h = mix(h * _BASE + w[i : i + n])
    return np.unique(h)


def minwise(s: np.ndarray) -> np.ndarray:
    """The COORDINATES minwise tokens of a set."""
    out = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(s), 8192):
        out = np.minimum(out, (_ODD[:, None] * s[None, at : at + 8192]).min(axis=1))
    return out


def _as_long(b: bytes) -> int:
    return int.from_bytes(b, "little", signed=True)


def _signatures(k: int):
    def run(frames):
        for pdf in frames:
            rows = []
            for i, text in zip(pdf["id"].tolist(), pdf["text"].tolist()):
                s = shingles(text, k)
                if not len(s):
                    rows.append((i, 0, 0, 0, 0, 0, b""))
                    continue
                d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                m = minwise(s)
                bits = np.packbits(((m >> np.uint64(33)) & np.uint64(1)).astype(np.uint8)).tobytes()
                rows.append((i, len(s), _as_long(d[:8]), _as_long(d[8:]), _as_long(bits[:8]), _as_long(bits[8:]), (m >> np.uint64(32)).astype(np.uint32).tobytes()))
            out = pd.DataFrame(rows, columns=["id", "n", "key", "key2", "s1", "s2", "tokens"])
            out["id"] = out["id"].astype("Int64")
            yield out

    return run


def signatures(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """id, n (set size), key and key2 (digest of the set), s1 and s2 (sketch), tokens (minwise tokens)."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return materialize(rows.mapInPandas(_signatures(k), "id long, n long, key long, key2 long, s1 long, s2 long, tokens binary"), "signatures")


def _branch(similarity: float, roots: list[int] | None):
    """Children of each row's node; the roots of the trees where no node is given."""
    chance = 1 / (similarity * COORDINATES)
    numbers = np.arange(1, COORDINATES + 1, dtype=np.uint64)

    def chosen(node: int) -> np.ndarray:
        u = mix(np.uint64(node & (2**64 - 1)) + numbers * _BASE)
        picked = np.flatnonzero(u < np.uint64(int(chance * 2**64)))
        return picked if len(picked) else np.array([int(u.argmin())])

    def run(frames):
        memo: dict[int, np.ndarray] = {}
        for pdf in frames:
            nodes, keys = [], []
            tokens = [np.frombuffer(t, np.uint32) for t in pdf["tokens"]]
            given = pdf["node"].tolist() if roots is None else None
            for r in [None] if roots is None else roots:
                for j, t in enumerate(tokens):
                    node = given[j] if r is None else r
                    if node not in memo:
                        memo[node] = chosen(node)
                    c = memo[node]
                    child = mix(mix(np.uint64(node & (2**64 - 1)) + _BASE * (c.astype(np.uint64) + np.uint64(1))) + t[c].astype(np.uint64))
                    nodes.append(child.view(np.int64))
                    keys.append(np.full(len(c), j))
            if nodes:
                at = np.concatenate(keys)
                yield pd.DataFrame({"node": np.concatenate(nodes), "key": pdf["key"].to_numpy()[at], "s1": pdf["s1"].to_numpy()[at], "s2": pdf["s2"].to_numpy()[at]})

    return run


NODE = "node long, key long, s1 long, s2 long"


def most_differing(similarity: float) -> int:
    """Bits in which the sketches of a pair at the threshold may differ."""
    share = (1 - similarity) / 2
    return int(np.ceil(COORDINATES * share + SLACK * np.sqrt(COORDINATES * share * (1 - share))))


def differing(a1, a2, b1, b2):
    return F.bit_count(a1.bitwiseXOR(b1)) + F.bit_count(a2.bitwiseXOR(b2))


def forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    left = near.any(axis=1)
    tree: list[tuple[np.ndarray, np.ndarray]] = []
    while left.any():
        edge = np.array([int(left.argmax())])
        left[edge] = False
        while len(edge):
            reach = near[edge] & left
            new = np.flatnonzero(reach.any(axis=0))
            tree.append((edge[reach[:, new].argmax(axis=0)], new))
            left[new] = False
            edge = new
    return np.concatenate([x[0] for x in tree] or [[]]).astype(int), np.concatenate([x[1] for x in tree] or [[]]).astype(int)


def groups_of(*columns: np.ndarray):
    """(start, end) of the runs of equal rows in sorted columns."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(new)
    return list(zip(starts.tolist(), np.r_[starts[1:], n].astype(int).tolist()))


def in_blocks(n: int):
    """Runs of at most BLOCK of n rows, so that what is worked out for pairs takes BLOCK x n at a time."""
    return [slice(a, min(n, a + BLOCK)) for a in range(0, n, BLOCK)]


def allowed(s1: np.ndarray, s2: np.ndarray, root: np.ndarray, most: int) -> np.ndarray:
    """Pairs across components whose sketches differ by at most `most` bits."""
    out = np.zeros((len(s1), len(s1)), bool)
    for b in in_blocks(len(s1)):
        d = np.bitwise_count(s1[b, None] ^ s1[None, :]).astype(np.int16) + np.bitwise_count(s2[b, None] ^ s2[None, :])
        out[b] = (d <= most) & (root[b, None] != root[None, :])
    return out


def _compare(most: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["node", "tile", "key"])
        key, root = pdf["key"].to_numpy(), pdf["root"].to_numpy()
        s1, s2 = pdf["s1"].to_numpy().view(np.uint64), pdf["s2"].to_numpy().view(np.uint64)
        found = [(np.zeros(0, np.int64),) * 2]
        for a, b in groups_of(pdf["node"].to_numpy(), pdf["tile"].to_numpy()):
            if b - a > 1:
                i, j = forest(allowed(s1[a:b], s2[a:b], root[a:b], most))
                found.append((key[a + i], key[a + j]))
        return pd.DataFrame({"a": np.concatenate([x[0] for x in found]), "b": np.concatenate([x[1] for x in found])}).drop_duplicates()

    return run


def bucketed(rows: DataFrame, n: int, held: int, *group: str) -> DataFrame:
    """n rows dealt by `bucket`: whole groups, so many that a bucket holds about `held` rows, over at least as many tasks as a shuffle has."""
    buckets = max(1, n // held)
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // (30 * held))
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*group), F.lit(buckets)).cast("int")).repartition(tasks, "bucket")


def compare_nodes(rows: DataFrame, most: int) -> DataFrame:
    """a, b: spanning trees of what the sketches allow in small nodes. rows: node, tile, key, s1, s2, root; at most about SMALL + OTHERS rows a (node, tile)."""
    return bucketed(rows, rows.count(), HELD_ROWS, "node", "tile").groupBy("bucket").applyInPandas(_compare(most), "a long, b long")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of sorted sets, exactly, by products of 0/1 matrices over the shingles that several sets hold, a range of hashes at a time."""
    n = len(sets)
    out = np.zeros((n, n), np.int32)
    ranges = max(1, -(-sum(map(len, sets)) // RANGE))
    edges = np.array([(i << 64) // ranges for i in range(1, ranges)], np.uint64)
    cuts = [np.r_[0, np.searchsorted(s, edges), len(s)] for s in sets]
    width = max(256, 2_000_000 // n)
    for i in range(ranges):
        parts = [s[c[i] : c[i + 1]] for s, c in zip(sets, cuts)]
        values, at, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(n), [len(x) for x in parts])
        shared = counts[at] > 1
        number = np.cumsum(counts > 1) - 1
        at, owner = number[at[shared]], owner[shared]
        order = np.argsort(at, kind="stable")
        at, owner = at[order], owner[order]
        for low in range(0, int(at[-1]) + 1 if len(at) else 0, width):
            a, b = np.searchsorted(at, [low, low + width])
            m = np.zeros((n, width), np.float32)
            m[owner[a:b], at[a:b] - low] = 1
            for rows in in_blocks(n):
                out[rows] += (m[rows] @ m.T).astype(np.int32)
    return out


def linking(able: np.ndarray, sets: list[np.ndarray], whole: int) -> np.ndarray:
    """Of the pairs that are able, those whose intersection is `whole` hundredths of their union, or more."""
    sizes = np.array([len(x) for x in sets])
    both = overlaps(sets)
    for b in in_blocks(len(sets)):
        able[b] &= (100 + whole) * both[b].astype(np.int64) >= whole * (sizes[b, None] + sizes[None, :])
    return able


def _settle(k: int, similarity: float, most: int):
    whole = round(similarity * 100)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["node", "tile", "key"])
        key, root = pdf["key"].to_numpy(), pdf["root"].to_numpy()
        s1, s2 = pdf["s1"].to_numpy().view(np.uint64), pdf["s2"].to_numpy().view(np.uint64)
        found = [(np.zeros(0, np.int64),) * 2]
        for a, b in groups_of(pdf["node"].to_numpy(), pdf["tile"].to_numpy()):
            able = allowed(s1[a:b], s2[a:b], root[a:b], most)
            used = np.flatnonzero(able.any(axis=1))
            if not len(used):
                continue
            sets = [shingles(t, k) for t in pdf["text"].iloc[a + used]]
            i, j = forest(linking(able[np.ix_(used, used)], sets, whole))
            found.append((key[a + used[i]], key[a + used[j]]))
        return pd.DataFrame({"a": np.concatenate([x[0] for x in found]), "b": np.concatenate([x[1] for x in found])}).drop_duplicates()

    return run


def settle(trees: DataFrame, classes: DataFrame, labels: DataFrame, docs: DataFrame, k: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """a, b: confirmed links that join components, from the families that the spanning trees make.

    A family whose members all have one root joins nothing more. Of a large one with few members outside its largest component those are
    held against blocks of all; blocks hold about HELD_SHINGLES shingles at most (or one text), so long texts make small blocks.
    """
    most = most_differing(similarity)
    members = components(materialize(trees, "trees")).select("key", F.col("root").alias("node"))
    members = rooted(members.join(classes.select("key", "n", "s1", "s2"), "key"), labels)
    members = materialize(mixed(materialize(members, "rooted")), "mixed-families")
    weights = members.groupBy("node").agg(F.first("size").alias("size"), F.sum("n").alias("weight"), F.sum(F.when(F.col("root") != F.col("main"), F.col("n")).otherwise(0)).alias("outside"))
    weights = materialize(weights, "family-weights")
    members = materialize(of_nodes(members.drop("size"), members.count(), weights), "families")
    is_small = (F.col("size") <= SMALL) & (F.col("weight") <= HELD_SHINGLES)
    is_few = ~is_small & (F.col("others") <= OTHERS) & (F.col("outside") <= HELD_SHINGLES)
    blocks = lambda rows: F.greatest(F.ceil(F.col("size") / rows), F.ceil(2 * F.col("weight") / HELD_SHINGLES)).cast("long")
    small = members.where(is_small).withColumn("tile", F.lit(0).cast("long"))
    rows = small.unionByName(against(members.where(is_few), blocks(SMALL))).unionByName(tiles(members.where(~is_small & ~is_few), blocks(SMALL // 2)))
    rows = rows.select("node", "tile", "key", "s1", "s2", "root", "n")
    rows = materialize(rows, "family-rows")
    texts = texts_of(members.select("key"), classes, docs, k, id_col, text_col)
    whole, n = rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    share = HELD_SHINGLES * n // max(1, whole)  # rows that hold so many shingles on average
    dealt = bucketed(rows.drop("n").join(texts, "key"), n, max(1, min(HELD_ROWS, share)), "node", "tile")
    return materialize(dealt.groupBy("bucket").applyInPandas(_settle(k, similarity, most), "a long, b long"), "late-links")


def _confirm(k: int, similarity: float):
    whole = round(similarity * 100)

    def run(frames):
        hub, own = None, None
        for pdf in frames:
            keep = []
            for a, salt, member, text in zip(pdf["a"].tolist(), pdf["salt"].tolist(), pdf["member"].tolist(), pdf["text"]):
                s = shingles(text, k)
                if not member:  # a hub comes before its members
                    hub, own = (a, salt), s
                    keep.append(False)
                    continue
                if hub != (a, salt):
                    raise ValueError("a member without its hub")
                both = len(np.intersect1d(own, s, assume_unique=True)) if min(len(own), len(s)) * 100 >= whole * max(len(own), len(s)) else 0
                keep.append(100 * both >= whole * (len(own) + len(s) - both))
            yield pdf.loc[np.array(keep, bool), ["a", "b"]]

    return run


def _texts_of(k: int):
    def run(frames):
        for pdf in frames:
            same = []
            for t, d1, d2 in zip(pdf["text"], pdf["d1"].tolist(), pdf["d2"].tolist()):
                d = hashlib.blake2b(shingles(t, k).tobytes(), digest_size=16).digest()
                same.append((_as_long(d[:8]), _as_long(d[8:])) == (d1, d2))
            yield pdf.loc[same, ["key", "text"]]

    return run


def texts_of(keys: DataFrame, classes: DataFrame, docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """key, text of the classes named by keys: a text of document rep whose shingle set has the class's digest."""
    need = materialize(keys.join(classes.select("key", "rep", "d1", "d2"), "key"), "needed")
    if need.count() <= FETCH_ROWS:
        need = F.broadcast(need)
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text")).join(need, "rep")
    texts = materialize(texts.select("key", "text", "d1", "d2").mapInPandas(_texts_of(k), "key long, text string"), "texts")
    return texts.dropDuplicates(["key"])


def confirm(stars: DataFrame, classes: DataFrame, docs: DataFrame, k: int, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """The pairs (a: hub, b: member, as class keys) whose full shingle sets are similar enough.

    Members are dealt by (hub, salt), SALTED a salt, and follow one row of the hub's text: a task holds one hub's set and one member's at a time.
    """
    stars = materialize(stars, "stars")
    salts = stars.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALTED).cast("int").alias("salts"))
    keys = stars.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    texts = texts_of(keys, classes, docs, k, id_col, text_col)
    hubs = salts.join(texts, salts["a"] == texts["key"]).select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("a").alias("b"), F.lit(False).alias("member"), "text")
    members = stars.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts").cast("long")).cast("int"))
    members = members.join(texts.select(F.col("key").alias("b"), "text"), "b").select("a", "salt", "b", F.lit(True).alias("member"), "text")
    tasks = max(int(stars.sparkSession.conf.get("spark.sql.shuffle.partitions")), stars.count() // (30 * HELD_ROWS))
    dealt = hubs.unionByName(members).repartition(tasks, "a", "salt").sortWithinPartitions("a", "salt", "member")
    return materialize(dealt.mapInPandas(_confirm(k, similarity), "a long, b long").distinct(), "links")


def components(links: DataFrame) -> DataFrame:
    """key, root (smallest key of its component) for every end of a link.

    Every key moves to its smallest neighbour and the links move along; what is left of them shrinks from round
    to round until none joins two keys. A table a round cuts the lineage.
    """

    def between(edges: DataFrame) -> DataFrame:
        low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        return materialize(edges.where("a <> b").select(low, high).distinct(), "between")

    edges = between(links)
    labels = edges.select(F.explode(F.array("a", "b")).alias("key")).distinct().withColumn("root", F.col("key"))
    while not edges.isEmpty():
        ends = edges.groupBy(F.col("b").alias("from")).agg(F.min("a").alias("to"))
        step = materialize(ends, "step")
        labels = moved(labels, "root", step)
        edges = between(moved(moved(edges, "a", step), "b", step))
    return materialize(labels, "labels")


def moved(rows: DataFrame, column: str, step: DataFrame) -> DataFrame:
    """rows with the column's keys moved by one step."""
    return rows.join(step, rows[column] == step["from"], "left").withColumn(column, F.coalesce("to", column)).drop("from", "to")


def rooted(rows: DataFrame, labels: DataFrame) -> DataFrame:
    own = labels.select("key", F.col("root").alias("_root"))
    return rows.join(own, "key", "left").withColumn("root", F.coalesce("_root", "key")).drop("_root")


def of_nodes(rows: DataFrame, n: int, nodes: DataFrame) -> DataFrame:
    """The n rows joined to what is known of their nodes (stored: node, size, ...; a row a node).

    A node of so many rows that it would weigh on one task goes to its rows instead of meeting them in a shuffle; there are HOT_NODES of them
    at most, as each holds more than n / HOT_NODES rows.
    """
    limit = max(HOT_ROWS, n // HOT_NODES)
    hot = F.broadcast(nodes.where(F.col("size") > limit))
    rest = rows.join(hot.select("node"), "node", "left_anti").join(nodes.where(F.col("size") <= limit), "node")
    return rest.unionByName(rows.join(hot, "node"))


def mixed(rows: DataFrame) -> DataFrame:
    """Rows (stored) of nodes with several components, with the node's size, its largest component and the rows outside that. rows: node, key, s1, s2, root."""
    parts = rows.groupBy("node", "root").agg(F.count(F.lit(1)).alias("n"))
    sizes = parts.groupBy("node").agg(F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("most"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    sizes = materialize(sizes.select("node", "size", F.col("most.root").alias("main"), (F.col("size") - F.col("most.n")).alias("others")), "node-sizes")
    return of_nodes(rows, rows.count(), sizes)


def hubs_of(rows: DataFrame, n: int) -> DataFrame:
    """node, size and hub (key, s1, s2), stored, of nodes with several members: in large ones the member nearest to the majority of the sketches. rows: n of them, stored."""
    first = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("key", "s1", "s2")).alias("hub")).where("size > 1")
    first = materialize(first, "first-members")
    large = first.where(F.col("size") > CENTRAL).select("node", "size")

    def majority(c: str):
        """The bits that more than half of the members have set; as one text, since 64 column objects take seconds to build."""
        return F.expr(" | ".join(f"if(2 * sum(cast(getbit({c}, {i}) as int)) > count(1), shiftleft(1L, {i}), 0L)" for i in range(64)))

    centre = of_nodes(rows, n, large).groupBy("node").agg(F.first("size").alias("size"), majority("s1").alias("m1"), majority("s2").alias("m2"))
    centre = materialize(centre, "majorities")
    off = differing(F.col("s1"), F.col("s2"), F.col("m1"), F.col("m2"))
    best = of_nodes(rows, n, centre).groupBy("node").agg(F.first("size").alias("size"), F.min(F.struct(off.alias("off"), "key", "s1", "s2")).alias("b"))
    best = best.select("node", "size", F.struct("b.key", "b.s1", "b.s2").alias("hub"))
    return materialize(first.where(F.col("size") <= CENTRAL).select("node", "size", "hub").unionByName(best), "hubs")


def near_duplicates(docs: DataFrame, *args, **kwargs) -> DataFrame:
    """id, n_shingles, component (smallest id reachable over links) for every row of docs. Parameters: those of _near_duplicates()."""
    with batches(docs.sparkSession):
        return _near_duplicates(docs, *args, **kwargs)


def _near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, trees: int = TREES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component (smallest id reachable over links) for every row of docs."""
    signed = signatures(docs, shingle, id_col, text_col)
    whole = F.struct("id", "s1", "s2", "tokens")
    classes = signed.where("n > 0").groupBy("key", "key2").agg(F.min(F.when(F.col("id").isNotNull(), whole)).alias("r"), F.first(F.struct("s1", "s2", "tokens"), ignorenulls=True).alias("any"), F.first("n").alias("n"))
    classes = classes.select(F.col("key").alias("d1"), F.col("key2").alias("d2"), F.col("r.id").alias("rep"), "n", F.col("any.s1").alias("s1"), F.col("any.s2").alias("s2"), F.col("any.tokens").alias("tokens"))
    classes = materialize(classes, "classes")
    # sets that share d1 but not d2 have keys of their own; there is hardly ever one
    shared = materialize(classes.groupBy("d1").agg(F.min("d2").alias("least"), F.count(F.lit(1)).alias("sets")).where("sets > 1").drop("sets"), "shared-keys")
    classes = classes.join(shared, "d1", "left").withColumn("key", F.when(F.col("least") < F.col("d2"), F.xxhash64("d1", "d2")).otherwise(F.col("d1"))).drop("least")
    named = classes.where("rep is not null")
    most = most_differing(similarity)

    roots = [int(x) for x in mix(np.arange(1, trees + 1, dtype=np.uint64) * _BASE).view(np.int64)]
    rows = named.select("key", "s1", "s2", "tokens").mapInPandas(_branch(similarity, roots), NODE)
    rows = materialize(rows, "nodes")
    n = rows.count()
    rows = materialize(of_nodes(rows, n, hubs_of(rows, n)), "shared-nodes")
    near = differing(F.col("s1"), F.col("s2"), F.col("hub.s1"), F.col("hub.s2")) <= most
    stars = rows.where((F.col("key") != F.col("hub.key")) & near).select(F.col("hub.key").alias("a"), F.col("key").alias("b")).distinct()
    links = confirm(stars, classes, docs, shingle, similarity, id_col, text_col)
    labels = components(links)

    left = materialize(rooted(rows.select("node", "key", "s1", "s2"), labels), "rooted")
    left = materialize(mixed(left), "mixed")
    pairs = []
    for depth in range(DEPTH + 1):
        small = left.where(F.col("size") <= SMALL).withColumn("tile", F.lit(0).cast("long"))
        few = against(left.where((F.col("size") > SMALL) & (F.col("others") <= OTHERS)))
        pairs.append(compare_nodes(small.unionByName(few), most))
        large = left.where((F.col("size") > SMALL) & (F.col("others") > OTHERS))
        if large.isEmpty():
            break
        if depth == DEPTH:
            pairs.append(compare_nodes(tiles(large), most))
            break
        grown = large.select("node", "key").join(classes.select("key", "s1", "s2", "tokens"), "key").mapInPandas(_branch(similarity, None), NODE)
        left = materialize(mixed(materialize(rooted(grown, labels), "rooted")), "mixed")
    more = pairs[0]
    for p in pairs[1:]:
        more = more.unionByName(p)
    late = settle(more, classes, labels, docs, shingle, similarity, id_col, text_col)
    joined = rooted(rooted(late.select(F.col("a").alias("key"), "b"), labels).select(F.col("root").alias("a"), F.col("b").alias("key")), labels)
    over = components(joined.select("a", F.col("root").alias("b")).where("a <> b").distinct())

    final = rooted(classes.select("key", "rep", "d1", "d2"), labels)
    upper = over.select(F.col("key").alias("root"), F.col("root").alias("_top"))
    final = final.join(upper, "root", "left").withColumn("top", F.coalesce("_top", "root"))
    least = final.groupBy("top").agg(F.min("rep").alias("component"))
    final = materialize(final.join(least, "top").select(F.col("d1").alias("key"), F.col("d2").alias("key2"), "component"), "components")
    out = signed.select("id", "n", "key", "key2").join(final, ["key", "key2"], "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component"))


def against(rows: DataFrame, blocks=None) -> DataFrame:
    """Rows of large nodes: blocks (SMALL rows each) of the largest component, each with all rows outside it."""
    rows = rows.withColumn("_n", F.ceil(F.col("size") / SMALL).cast("long") if blocks is None else blocks)
    own = F.pmod(F.xxhash64("key", "node"), F.col("_n"))
    every = F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)
    return rows.withColumn("tile", F.explode(F.when(F.col("root") == F.col("main"), F.array(own)).otherwise(every))).drop("_n")


def tiles(rows: DataFrame, blocks=None) -> DataFrame:
    """Rows of nodes too large to compare at once, dealt into pairs of blocks (of SMALL / 2 rows each)."""
    spread = rows.withColumn("_n", F.ceil(F.col("size") / (SMALL // 2)).cast("long") if blocks is None else blocks)
    spread = spread.withColumn("_own", F.pmod(F.xxhash64("key", "node"), F.col("_n"))).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    return spread.withColumn("tile", F.least("_own", "_other") * F.col("_n") + F.greatest("_own", "_other")).drop("_n", "_own", "_other")
