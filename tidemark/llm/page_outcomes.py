"""Outcomes of web pages, learnt from labelled documents. DataFrame functions only.

A page's text is judged by a naive Bayes model over binned counts of a text (PER_MILLE shares of its characters or
words). The model is a table of at most len(STATISTICS) x (len(EDGES) + 1) bins, counted over all labelled documents and
compiled into one expression; only that table reaches the driver. A page is bad where its text is likelier to be of
label 0 than of label 1, or where its url holds one of the words of bad pages.

Defined results: white space is one blank before anything is counted; a page without text and without such a word has
no outcome (null), and so have all where nothing is labelled; a document labelled both ways counts for both.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, materialize

# Characters that are counted, by the name of the statistic
COUNTED = {"upper": "A-Z", "digits": "0-9", "symbols": "!#$%&*+<=>@^_~|{}", "stops": ".,;:"}
STATISTICS = (*COUNTED, "gaps", "distinct", "words")
# A bin's lower edge, per mille (of words: their number)
EDGES = (1, 2, 3, 6, 11, 21, 51, 101, 151, 201, 301, 501, 701, 901, 1000)
# Words of urls that a page is bad for
BAD_WORDS = ("adult", "ads", "bet", "bets", "betting", "casino", "gambling", "pills", "poker", "porn", "sex", "spam", "viagra", "xxx")

#: Labelled ids up to which they are broadcast to the documents.
KNOWN_ROWS = 2_000_000

ARTICLE = "(?s)<article[^>]*>(.*?)</article>"
HIDDEN = "(?is)<(script|style)[^>]*>.*?</(script|style)>"
TAG = "<[^>]*>"
BLANK = r"[\x09-\x0D\x20]+"
# Character references, the ampersand last
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def spaced(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), BLANK, " "))


def page_text(html: Column) -> Column:
    """The text of a page's article, of the whole page if it has none."""
    article = F.regexp_extract(html, ARTICLE, 1)
    out = F.regexp_replace(F.when(article == "", F.regexp_replace(html, HIDDEN, " ")).otherwise(article), TAG, " ")
    for name, character in REFERENCES:
        out = F.replace(out, F.lit(name), F.lit(character))
    return spaced(out)


def counts(text: Column) -> Column:
    """Counts of a text in spaced() form that the bins are made of, and its size; as a struct."""
    own = F.split(text, " ")
    each = [(F.length(text) - F.length(F.regexp_replace(text, f"[{c}]", ""))).alias(k) for k, c in COUNTED.items()]
    return F.struct(F.length(text).alias("size"), *each, F.size(F.array_distinct(own)).alias("distinct"), F.size(own).alias("words"))


def bins(of: Column) -> dict[str, Column]:
    """Bin of each statistic: how many EDGES it reaches. of: counts()."""
    whole = {k: F.greatest(of["size"], F.lit(1)) for k in (*COUNTED, "gaps")} | {"distinct": of["words"], "words": F.lit(1000)}
    reached = lambda n, size: sum((F.when(n.cast("long") * 1000 >= size * e, 1).otherwise(0) for e in EDGES), F.lit(0))
    return {k: reached(of["words" if k == "gaps" else k], whole[k]) for k in STATISTICS}


def through(text: Column, *steps) -> Column:
    """The last step's value. A step is a lambda, whose variable the plan computes once however often it is named."""
    out = F.array(text)
    for step in steps:
        out = F.transform(out, step)
    return F.get(out, F.lit(0))


class TextJudge:
    """log odds of label 0 by statistic and bin, and before any."""

    def __init__(self, first: float, odds: dict[tuple[str, int], float]):
        self.first, self.odds = first, odds

    def column(self, of: dict[str, Column]) -> Column:
        """log odds of label 0. of: bins() of a text."""
        total = F.lit(self.first)
        for s in STATISTICS:
            table = F.array(*[F.lit(self.odds.get((s, b), 0.0)) for b in range(len(EDGES) + 1)])
            total = total + F.get(table, of[s])
        return total


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label") -> TextJudge | None:
    """Counts over all labelled documents; None where not both labels occur. labels: id and label (0 or 1)."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).distinct()
    known = materialize(known, "page-labels")
    few = known.count() <= KNOWN_ROWS
    listed = through(spaced(F.col("text")), counts, lambda c: F.array(*[F.struct(F.lit(s).alias("s"), b.alias("b")) for s, b in bins(c).items()]))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # texts never move: few labels go to them, or else a text's bins go to the labels
    binned = texts.join(F.broadcast(known), "id").select("label", listed.alias("x")) if few else texts.select("id", listed.alias("x")).join(known, "id")
    each = binned.select("label", F.explode_outer("x").alias("x"))  # explode() would have the optimizer filter by the list's size, which computes it twice
    got = {(r["s"], r["b"], r["label"]): r["count"] for r in each.groupBy("x.s", "x.b", "label").count().collect()}
    n = [sum(v for (s, _, label), v in got.items() if (s, label) == (STATISTICS[0], c)) for c in (0, 1)]
    if not n[0] or not n[1]:
        return None
    share = lambda s, b, c: math.log((got.get((s, b, c), 0) + 1) / (n[c] + len(EDGES) + 1))
    odds = {(s, b): share(s, b, 0) - share(s, b, 1) for s in STATISTICS for b in range(len(EDGES) + 1)}
    return TextJudge(math.log((n[0] + 1) / (n[1] + 1)), odds)


def has_bad_word(url: Column) -> Column:
    return F.coalesce(lower_ascii(url).rlike(f"(^|[^a-z])({'|'.join(BAD_WORDS)})([^a-z]|$)"), F.lit(False))


def outcomes(pages: DataFrame, judge: TextJudge | None, out: str, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """pages, stored, without html_col and with out: 1 (bad), 0 or null."""
    bad = lambda c: F.when(c["size"] > 0, judge.column(bins(c)) > 0).cast("int")
    read = through(page_text(F.coalesce(F.col(html_col), F.lit(""))), counts, bad) if judge else F.lit(None).cast("int")
    return materialize(pages.withColumn(out, F.when(has_bad_word(F.col(url_col)), 1).otherwise(read)).drop(html_col), "page-outcomes")
