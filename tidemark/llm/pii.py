"""PII by bootstrapped contextual extraction. DataFrame functions only.

Base matches of four kinds (e-mail address, IP address, card number, phone number) are the seeds. Every use of a
value induces lexical patterns: the word before and the word after it with the value's class, either word alone
with the class, and the value's shape (its class and the lengths of its groups) alone. Patterns and values (an
e-mail in lower case, or a number's digits) form a graph; over ROUNDS a pattern's confidence for a kind is the weighted
share of that kind among all values it is seen with, and an unknown value takes the best confidence of its
patterns. Seeds stay at 1, matches of their kind's length that failed its test at 0; other failed matches are no
evidence. Patterns of at least `support` seed values and a confidence of at least `confidence` discover
identifiers that the base expressions miss: values that could be of the kind.

A text is only taken apart by a kind's expression if a cheap test finds what the kind can't do without.
Expressions start where a run of their characters starts or the last match ended and give nothing back. Places of
matches and their overlaps are running sums and extremes over the matches of a text, so all takes time in
proportion to the text, and a text of many matches is many rows, not one long list, until its spans are returned.

Defined results: null and empty texts have no spans; offsets are code points, the end is exclusive; repeated
rows and ids get a row each; overlapping spans of different kinds all stay, discovered spans that overlap
a base span are dropped (a failed match drops none); a discovered span has the kind of its best pattern, of equally
good ones the first of KINDS; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import inner, materialize

KINDS = ("email", "ip", "card", "phone")
# The base expressions, in possessive form where that changes no match
LOCAL = "[A-Za-z0-9._%+-]"
EXPRESSIONS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", "card": r"(?:[0-9][\x20-]?){15}[0-9]"}
# values that are like an identifier, but need not match a kind
LIKE = {
    "number": r"(?<![A-Za-z0-9+(])[+(]?[0-9](?:[ ()./:_-]{0,2}[0-9]){6,24}(?![A-Za-z0-9])",
    "mail": rf"(?<!{LOCAL}){LOCAL}++ ?(?:@|\[at\]|\(at\)) ?[A-Za-z0-9-]++(?: ?(?:\.|\[dot\]|\(dot\)) ?[A-Za-z0-9-]++)*+",
}
MAIL = r"@|\[at\]|\(at\)"

ROUNDS = 3
SUPPORT = 5
CONFIDENCE = 0.9
#: Added to the weight of a pattern's values, against patterns seen but a few times.
DOUBT = 0.25
#: Code points of a block of a text that is being masked.
BLOCK = 1024


def matches_of(text: Column, name: str, expression: str) -> Column:
    """Leftmost non-overlapping matches: array of (name, pos, gap before it, size, value, word before, word after)."""
    parts, values = F.split(text, expression, -1), F.regexp_extract_all(text, F.lit(expression), F.lit(0))
    each = F.slice(F.arrays_zip(parts, F.slice(parts, 2, F.size(parts)), values), 1, F.size(values))
    return F.transform(
        each,
        lambda z, i: F.struct(
            F.lit(name).alias("name"),
            i.alias("pos"),
            F.length(z["0"]).alias("gap"),
            F.length(z["2"]).alias("size"),
            z["2"].alias("value"),
            F.lower(F.regexp_extract(z["0"], r"(?<!\S)(\S++)[ \t]*+\z", 1)).alias("left"),
            F.lower(F.regexp_extract(z["1"], r"\A[ \t]*+(\S++)", 1)).alias("right"),
        ),
    )


MATCH = "array<struct<name:string,pos:int,gap:int,size:int,value:string,left:string,right:string>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def fine(kind: str, value: Column) -> Column:
    """Whether a base match passes its kind's test."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return F.forall(F.split(value, r"\."), _at_most_255)
    n = F.length(digits(value))
    if kind == "card":
        return n.between(16, 19) & F.call_function("luhn_check", digits(value))
    return n.between(8, 15)


def of_length(kind: str, value: Column) -> Column:
    """Whether a base match has the length of its kind, so that a failed test tells that it is none."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda part: F.length(F.regexp_replace(part, "^0+", "")) <= 3)
    return F.length(digits(value)).between(16, 19) if kind == "card" else fine(kind, value)


def _at_most_255(part: Column) -> Column:
    short = F.regexp_replace(part, "^0+", "")
    return (F.length(short) < 3) | ((F.length(short) == 3) & (short <= "255"))


def near_shape(kind: str, value: Column) -> Column:
    """Whether an unknown value could be of the kind."""
    n = F.length(digits(value))
    mail = value.rlike(MAIL)
    if kind == "email":
        return mail
    if kind == "ip":
        return ~mail & value.rlike(r"^[0-9]{1,3}(?:[.:][0-9]{1,5}){3,4}$")
    if kind == "card":
        return ~mail & n.between(13, 19)
    return ~mail & n.between(7, 15) & ~value.rlike(r"^[0-9]+\.[0-9]+\.[0-9]+")


def plain_mail(value: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(value, r" ?(?:@|\[at\]|\(at\)) ?", "@"), r" ?(?:\.|\[dot\]|\(dot\)) ?", "."))


def value_of(value: Column) -> Column:
    return F.when(value.rlike(MAIL), plain_mail(value)).otherwise(digits(value))


def class_of(value: Column) -> Column:
    """A value's class: mail, dotted, or a number by how many digits it has."""
    n = F.length(digits(value))
    dotted = value.rlike(r"^[0-9]+[.:][0-9]+[.:][0-9]+[.:][0-9]+")
    return F.when(value.rlike(MAIL), "mail").when(dotted, "dotted").when(n < 13, "number").when(n < 16, "long number").when(n < 20, "card number").otherwise("longer number")


def shape_of(value: Column) -> Column:
    """Class and the lengths of the groups of digits, or of an address its parts."""
    groups = F.regexp_replace(F.regexp_replace(value, "^[^0-9]+", ""), "[^0-9]+", "-")
    mail = F.regexp_replace(plain_mail(value), r"[^.@]+", "a")
    return F.concat_ws(" ", class_of(value), F.when(value.rlike(MAIL), mail).otherwise(F.regexp_replace(groups, "[0-9]", "9")))


def patterns_of(left: Column, right: Column, value: Column) -> Column:
    """The patterns of a use: array of (left, right, shape), where null stands for anything."""
    kind = class_of(value)
    nothing = F.lit(None).cast("string")
    pattern = lambda a, b, s: F.struct(a.alias("left"), b.alias("right"), s.alias("shape"))
    has_left, has_right = left != "", right != ""
    every = F.array(
        pattern(nothing, nothing, shape_of(value)),
        F.when(has_left, pattern(left, nothing, kind)),
        F.when(has_right, pattern(nothing, right, kind)),
        F.when(has_left & has_right, pattern(left, right, kind)),
    )
    return F.array_compact(every)


def texts_apart(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """_row, id, found (matches of the base expressions and of what is like an identifier) of every row, stored."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast(MATCH)
    at, plus = F.contains(text, F.lit("@")), F.contains(text, F.lit("+"))
    able = {"email": at, "ip": text.rlike(NEEDS["ip"]), "card": text.rlike(NEEDS["card"]), "phone": plus}
    able |= {"number": text.rlike(LIKE["number"]), "mail": at | F.contains(text, F.lit("[at]")) | F.contains(text, F.lit("(at)"))}
    every = {**EXPRESSIONS, **LIKE}
    lists = [F.when(able[k], matches_of(text, k, every[k])).otherwise(none).alias(k) for k in every]
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(id_col).alias("id"), *lists)
    return materialize(rows.select("_row", "id", F.concat(*every).alias("found")), "pii-texts")


def placed(rows: DataFrame) -> DataFrame:
    """A row a match: _row, name, start, end, value, left, right, inst, fine (passed its kind's test), seed (or of its length). Unknown values are those named by LIKE;
    they are left out where they overlap a fine match, or repeat a failed seed. rows: texts_apart()."""
    each = rows.select("_row", F.explode("found").alias("m")).select("_row", "m.*")
    upto = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("_row", "name").orderBy("pos")).cast("int")
    each = each.select("_row", "name", (upto - F.col("size")).alias("start"), upto.alias("end"), "value", "left", "right", value_of(F.col("value")).alias("inst"))
    passed = seed = F.lit(False)
    for k in KINDS:
        passed = F.when(F.col("name") == k, fine(k, F.col("value"))).otherwise(passed)
        seed = F.when(F.col("name") == k, of_length(k, F.col("value"))).otherwise(seed)
    each = each.withColumns({"fine": passed, "seed": seed | passed})
    before = Window.partitionBy("_row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("_row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, -1)
    reach = F.max(F.when(F.col("fine"), F.col("end"))).over(before)
    ahead = F.min(F.when(F.col("fine"), F.col("start"))).over(behind)
    failed = F.max(F.col("seed") & ~F.col("fine")).over(Window.partitionBy("_row", "inst"))
    each = each.withColumns({"covered": F.coalesce(reach > F.col("start"), F.lit(False)) | F.coalesce(ahead < F.col("end"), F.lit(False)), "failed": failed})
    return each.where(F.col("name").isin(*KINDS) | (~F.col("covered") & ~F.col("failed"))).drop("covered", "failed")


def graph(matches: DataFrame, hidden: Column | None = None) -> DataFrame:
    """Edges (left, right, shape, inst) with w (weight), s_* (score by kind), fixed; stored. hidden: seeds that are to count as unknown (of inst)."""
    seed = F.col("seed") & ~hidden if hidden is not None else F.col("seed")
    kind = F.when(F.col("fine") & seed, F.col("name"))
    uses = matches.where(seed | ~F.col("name").isin(*KINDS) | F.col("fine")).select(F.explode(patterns_of(F.col("left"), F.col("right"), F.col("value"))).alias("p"), "inst", kind.alias("kind"), seed.alias("seed"))
    edges = uses.groupBy("p.left", "p.right", "p.shape", "inst").agg(F.count(F.lit(1)).alias("n"), *[F.max((F.col("kind") == k).cast("double")).alias(f"k_{k}") for k in KINDS], F.max("seed").alias("seed"))
    known = edges.groupBy("inst").agg(*[F.coalesce(F.max(f"k_{k}"), F.lit(0.0)).alias(f"s_{k}") for k in KINDS], F.max("seed").alias("fixed"))
    return materialize(edges.select("left", "right", "shape", "inst", F.sqrt("n").alias("w")).join(known, "inst"), "pii-edges")


def scored(edges: DataFrame) -> DataFrame:
    """Patterns with c_* (confidence by kind) and n_* (seed values of the kind)."""
    weigh = [(F.sum(F.col("w") * F.col(f"s_{k}")) / (F.sum("w") + DOUBT)).alias(f"c_{k}") for k in KINDS]
    held = [F.sum(F.when(F.col("fixed") & (F.col(f"s_{k}") > 0), 1).otherwise(0)).alias(f"n_{k}") for k in KINDS]
    return edges.groupBy("left", "right", "shape").agg(*weigh, *held)


def same_pattern(a: DataFrame, b: DataFrame):
    return a["left"].eqNullSafe(b["left"]) & a["right"].eqNullSafe(b["right"]) & (a["shape"] == b["shape"])


def patterns(edges: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """left, right, shape, kind, conf: the patterns of high confidence. edges: graph()."""
    now = edges
    for _ in range(rounds - 1):
        unknown, lending = now.where(~F.col("fixed")).select("left", "right", "shape", "inst"), scored(now)
        lent = unknown.join(lending, same_pattern(unknown, lending)).groupBy("inst").agg(*[F.max(f"c_{k}").alias(f"l_{k}") for k in KINDS])
        now = now.join(lent, "inst", "left").select("left", "right", "shape", "inst", "w", "fixed", *[F.when(F.col("fixed"), F.col(f"s_{k}")).otherwise(F.coalesce(F.col(f"l_{k}"), F.lit(0.0))).alias(f"s_{k}") for k in KINDS])
        now = materialize(now, "pii-edges")
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"c_{k}").alias("conf"), F.col(f"n_{k}").alias("n")) for k in KINDS]))
    return scored(now).select("left", "right", "shape", each.alias("p")).select("left", "right", "shape", "p.*").where((F.col("conf") >= confidence) & (F.col("n") >= support)).drop("n")


def discovered(unknown: DataFrame, good: DataFrame) -> DataFrame:
    """_row, kind, start, end, value of the unknown matches that a pattern of high confidence finds."""
    uses = unknown.select("_row", "start", "end", "value", F.explode(patterns_of(F.col("left"), F.col("right"), F.col("value"))).alias("p")).select("_row", "start", "end", "value", "p.*")
    shape = F.lit(False)
    for k in KINDS:
        shape = F.when(F.col("kind") == k, near_shape(k, F.col("value"))).otherwise(shape)
    hits = uses.join(good, same_pattern(uses, good)).where(shape).select("_row", "start", "end", "value", "kind", "conf")
    return hits.groupBy("_row", "start", "end", "value").agg(F.max(F.struct("conf", (-number_of(F.col("kind"))).alias("i"), "kind"))["kind"].alias("kind"))


def number_of(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def span_rows(docs: DataFrame, support: int, confidence: float, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(_row, id) of every row, and a row a span: _row, kind, start, end, base."""
    rows = texts_apart(docs, id_col, text_col)
    matches = materialize(placed(rows), "pii-matches")
    good = materialize(patterns(graph(matches), support, confidence), "pii-patterns")
    base = matches.where(F.col("fine")).select("_row", F.col("name").alias("kind"), "start", "end", F.lit(True).alias("base"))
    new = discovered(matches.where(~F.col("name").isin(*KINDS)), good).select("_row", "kind", "start", "end", F.lit(False).alias("base"))
    return rows.select("_row", "id"), base.unionByName(new)


SPANS = "array<struct<kind:string,start:int,end:int>>"


def extract(docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base and spans: arrays of (kind, start, end) in the order of KINDS, then start; spans holds base and discovered ones."""
    rows, each = span_rows(docs, support, confidence, id_col, text_col)
    place = F.struct(number_of(F.col("kind")).alias("i"), "start", "end", "kind", "base")
    lists = each.groupBy("_row").agg(F.sort_array(F.collect_list(place)).alias("all"))
    bare = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    lists = lists.select("_row", F.transform(F.filter("all", lambda s: s["base"]), bare).alias("base"), F.transform("all", bare).alias("spans"))
    none = F.array().cast(SPANS)
    return rows.join(lists, "_row", "left").select(F.col("id").alias(id_col), F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def unions(each: DataFrame) -> DataFrame:
    """_row, cuts: the text's spans as an array of (after, start, end, kind); overlapping ones are one, of the first's kind by start; after is the end of the one before."""
    order = Window.partitionBy("_row").orderBy("start", F.desc("end"), "kind")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = each.withColumn("new", (F.col("start") >= F.coalesce(reach, F.lit(0))).cast("int"))
    numbered = new.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("_row", "part").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max_by("kind", "new").alias("kind"))
    after = F.coalesce(F.lag("end").over(Window.partitionBy("_row").orderBy("start")), F.lit(0))
    return whole.withColumn("after", after).groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("after", "start", "end", "kind"))).alias("cuts"))


def blocks_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def masked(blocks: Column, cuts: Column) -> Column:
    """The text with the cuts of unions() replaced by their kinds in angle brackets. blocks: a column of blocks_of() the text, so that this takes time in proportion to it."""

    def between(low: Column, high: Column) -> Column:
        """Code points low to high - 1."""
        first, last = F.floor(low / BLOCK).cast("int"), F.floor(high / BLOCK).cast("int")
        inside = F.array_join(F.slice(blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        head = F.coalesce(F.substring(F.get(blocks, first), low % BLOCK + 1, F.when(first == last, high - low).otherwise(F.lit(BLOCK))), F.lit(""))
        tail = F.when(last > first, F.coalesce(F.substring(F.get(blocks, last), F.lit(1), high % BLOCK), F.lit(""))).otherwise("")
        return F.concat(head, inside, tail)

    parts = F.transform(cuts, lambda c: F.concat(between(c["after"], c["start"]), F.lit("<"), c["kind"], F.lit(">")))
    return F.concat(F.array_join(parts, ""), between(F.element_at(cuts, -1)["end"], F.size(blocks) * BLOCK))


def redact(docs: DataFrame, broadcast_rows: int, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """docs with all spans masked and chars_col, if there, the new length. Texts without spans (and null ones) stay as they are."""
    digest, name, own, cuts, blocks = inner("hash"), inner("id"), inner("own"), inner("cuts"), inner("blocks")
    hashed = docs.withColumn(digest, F.xxhash64(text_col))
    keyed = hashed.select(F.struct(F.col(id_col).alias("id"), F.col(digest).alias("hash")).alias("key"), F.col(text_col).alias("text"))
    rows, each = span_rows(keyed, SUPPORT, CONFIDENCE, "key", "text")
    found = rows.join(unions(each), "_row").select(F.col("id.id").alias(name), F.col("id.hash").alias(own), F.col("cuts").alias(cuts))
    few = materialize(found.dropDuplicates([name, own]), "pii-spans")
    few = F.broadcast(few) if few.count() <= broadcast_rows else few
    joined = hashed.join(few, F.col(id_col).eqNullSafe(F.col(name)) & (F.col(digest) == F.col(own)), "left")
    # a generated column is computed once, whatever is done with the text
    joined = joined.withColumn(blocks, F.explode_outer(F.array(F.when(F.col(cuts).isNotNull(), blocks_of(F.col(text_col))))))
    text = F.when(F.col(cuts).isNull(), F.col(text_col)).otherwise(masked(F.col(blocks), F.col(cuts)))
    out = joined.withColumn(text_col, text)
    if chars_col in docs.columns:
        out = out.withColumn(chars_col, F.when(F.col(cuts).isNull(), F.col(chars_col)).otherwise(F.length(text_col).cast("long")))
    return out.select(*docs.columns)


def rediscovery(docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A measure of the patterns: a fifth of the seed values (by hash) is hidden from the graph and sought by what the others induce.

    kind, hidden (uses of hidden values of that kind), found (those found as that kind), wrong (uses found as that kind that are none: a fine
    value of another kind, or one that failed its kind's test).
    """
    away = F.pmod(F.xxhash64("inst"), F.lit(5)) == 0
    matches = materialize(placed(texts_apart(docs, id_col, text_col)), "pii-matches")
    good = materialize(patterns(graph(matches, away), support, confidence), "pii-patterns")
    sought = matches.where(F.col("name").isin(*KINDS) & ((F.col("fine") & away) | (F.col("seed") & ~F.col("fine"))))
    got = discovered(sought, good).select("_row", "start", "end", "kind")
    judged = sought.select("_row", "start", "end", "name", "fine").join(got, ["_row", "start", "end"], "left")
    hidden = judged.where("fine").groupBy(F.col("name").alias("kind")).agg(F.count(F.lit(1)).alias("hidden"), F.count_if(F.col("kind") == F.col("name")).alias("found"))
    right = F.max(F.col("fine") & (F.col("kind") == F.col("name"))).over(Window.partitionBy("_row", "start", "end"))
    wrong = judged.where("kind is not null").withColumn("right", right).where(~F.col("right")).groupBy("kind").agg(F.countDistinct("_row", "start", "end").alias("wrong"))
    return hidden.join(wrong, "kind", "full").select("kind", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("hidden", "found", "wrong")])
