"""Quality by an interpolated modified Kneser-Ney model of byte n-grams, trained on trusted text.

Trusted documents are dealt to two halves by a hash of their text. The first half is counted: each task sums up its own
n-grams, and the sums are joined by n-gram, order by order. Below the highest order a count is the number of
different bytes seen before an n-gram. Each order has discounts for counts of one, two, and three or more, from
how many n-grams have each count. Joins with the sums of each context and with the order below give
every n-gram its probability, and every context its weight for the order below.

Texts are dealt to chunks of a bounded size by a hash of their rows. Each chunk asks for the n-grams that it holds, once each. What
is asked for is joined with the tables of all orders, sharded by n-gram and by context as Spark's joins are (a table of few rows is
sent to all tasks instead), and what it costs goes back to the chunk, which sums it up text by text. So neither a large model nor what is asked for is ever in one place, and
either may grow with the corpus without a worker growing with it.

The second half gives thresholds: for each language, a quantile of what its documents cost, plus a margin. Cost is
nats a byte, drawn to the language's mean by PRIOR bytes, so short texts need more than one odd word. Documents
above their language's threshold are rejected. A language without trusted text takes the threshold of all.

Cases: null and empty texts have no perplexity and are rejected; without trusted text (of either half) nothing else is
rejected and perplexity is null; a null language is one of its own; repeated rows are scored each; an empty table
gives no rows; further columns are kept where `keep` names them, but for those that are named like a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.common import bound_batches, give_back, materialize, sparing

ORDER = 5
#: Bytes of a chunk of texts that asks for its n-grams together, about.
CHUNK = 16_000_000
#: Bytes that are looked at together, and different n-grams that a counting task holds.
PART, HELD = 2_000_000, 2_000_000
#: Rows of a table of ids or languages, and of one of n-grams, up to which it is broadcast in a join; with more, both sides are shuffled.
BROADCAST_ROWS, BROADCAST_GRAMS = 1_000_000, 300_000
PRIOR = 150
QUANTILE, MARGIN = 0.99, 0.15


def grams_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of all texts, as a number, and each text's number of bytes. Zeros stand before a text."""
    raw = [(t or "").encode() for t in texts]
    pad = bytes(ORDER - 1)
    data = np.frombuffer(b"".join(x for r in raw for x in (pad, r)), np.uint8)
    n = np.array(list(map(len, raw)), np.int64)
    key = np.zeros(len(data), np.int64)
    for i in range(ORDER):
        key[i:] |= data[: len(data) - i].astype(np.int64) << (8 * i)
    own = np.ones(len(data), bool)
    begins = np.cumsum(n + ORDER - 1) - n - (ORDER - 1)
    for i in range(ORDER - 1):
        own[begins + i] = False
    return key[own], n


def _parts(values: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, list[str | None]]]:
    """(first row, texts) of parts of about PART bytes."""
    sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
    at = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= PART or i + 1 == len(sizes):
            yield at, values.slice(at, i + 1 - at).to_pylist()
            at, total = i + 1, 0


def counts(texts: DataFrame) -> DataFrame:
    """gram, n of the highest order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ns = np.zeros(0, np.int64), np.zeros(0, np.int64)
        made = lambda: pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ns)], names=["gram", "n"])
        for batch in batches:
            for _, part in _parts(batch.column(0)):
                more, n = np.unique(grams_of(part)[0], return_counts=True)
                keys, place = np.unique(np.concatenate([keys, more]), return_inverse=True)
                ns = np.bincount(place, np.concatenate([ns, n]), len(keys)).astype(np.int64)
                if len(keys) > HELD:
                    yield made()
                    keys, ns = keys[:0], ns[:0]
        if len(keys):
            yield made()

    return texts.mapInArrow(sparing(run), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discounts(table: DataFrame) -> tuple[float, float, float]:
    n1, n2, n3, n4 = (x or 0 for x in table.agg(*(F.sum(F.when(F.col("n") == k, 1).otherwise(0)) for k in (1, 2, 3, 4))).first())
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    ratio = lambda a, b: a / b if b else 0.5
    found = (1 - 2 * y * ratio(n2, n1), 2 - 3 * y * ratio(n3, n2), 3 - 4 * y * ratio(n4, n3))
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(found, 1))


def probabilities(grams: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """For the orders 1 to ORDER: (gram, p) of what was seen, and (context, weight) for the order below."""
    tables = [grams]
    for k in range(ORDER - 1, 0, -1):
        tables.insert(0, materialize(tables[0].groupBy(F.col("gram").bitwiseAND(F.lit(256**k - 1)).alias("gram")).agg(F.count(F.lit(1)).alias("n")), f"grams{k}"))
    seen: list[DataFrame] = []
    contexts: list[DataFrame] = []
    for k, table in enumerate(tables, 1):
        d1, d2, d3 = _discounts(table)
        off = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        parts = table.select("gram", F.shiftright("gram", 8).alias("context"), "n", off.alias("off"))
        sums = materialize(parts.groupBy("context").agg(F.sum("n").cast("double").alias("total"), F.sum("off").alias("freed")).select("context", "total", (F.col("freed") / F.col("total")).alias("weight")), f"contexts{k}")
        own = parts.join(sums, "context").select("gram", ((F.col("n") - F.col("off")) / F.col("total")).alias("p"), "weight")
        if k == 1:
            p = own.select("gram", (F.col("p") + F.col("weight") / 256).alias("p"))
        else:
            below = seen[-1].select(F.col("gram").alias("below"), F.col("p").alias("q"))
            p = own.join(below, F.col("gram").bitwiseAND(F.lit(256 ** (k - 1) - 1)) == F.col("below")).select("gram", (F.col("p") + F.col("weight") * F.col("q")).alias("p"))
        seen.append(materialize(p, f"p{k}"))
        contexts.append(sums.select("context", "weight"))
    return seen, contexts


def _side(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table as a side of a join."""
    return F.broadcast(df) if df.count() <= most else df


class Model:
    """The tables of all orders, as DataFrames."""

    def __init__(self, grams: DataFrame):
        self.seen, self.contexts = probabilities(grams)
        rest = self.contexts[0].first()
        self.empty = rest is None
        self.base = rest["weight"] / 256 if rest else 1 / 256

    def costs(self, asked: DataFrame) -> DataFrame:
        """asked (with gram) and nats: what the last byte of each n-gram costs after those before it."""
        own = lambda k: F.col("gram").bitwiseAND(F.lit(256**k - 1))
        found, p = asked, F.lit(self.base)
        for k in range(1, ORDER + 1):
            seen = self.seen[k - 1].select(F.col("gram").alias(f"_gram{k}"), F.col("p").alias(f"_p{k}"))
            found = found.join(_side(seen, BROADCAST_GRAMS), own(k) == F.col(f"_gram{k}"), "left")
            if k > 1:
                contexts = self.contexts[k - 1].select(F.col("context").alias(f"_context{k}"), F.col("weight").alias(f"_w{k}"))
                found = found.join(_side(contexts, BROADCAST_GRAMS), F.shiftright(own(k), 8) == F.col(f"_context{k}"), "left")
                p = F.coalesce(F.col(f"_w{k}"), F.lit(1.0)) * p
            p = F.coalesce(F.col(f"_p{k}"), p)
        return found.select(*asked.columns, (-F.log(F.greatest(p, F.lit(1e-30)))).cast("float").alias("nats"))


def score(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """`keep` of df, with nats (the text's cost) and n_bytes."""
    keep = tuple(c for c in keep if c not in ("nats", "n_bytes"))
    total = df.agg(F.sum(F.octet_length(text)).alias("n")).first()["n"] or 0
    own = df.select(F.col(text).alias("_text"), *(F.col(f"`{c}`").alias(f"_kept_{i}") for i, c in enumerate(keep) if c != text))
    hashed = [f.name for f in own.schema.fields if "map<" not in f.dataType.simpleString() and "variant" not in f.dataType.simpleString()]
    marked = own.select(F.pmod(F.xxhash64(*hashed), F.lit(max(1, ceil(total / CHUNK)))).cast("int").alias("_chunk"), "*")

    def ask(table: pa.Table) -> pa.Table:
        found = np.zeros(0, np.int64)
        for _, texts in _parts(table.column("_text")):
            found = np.union1d(found, np.unique(grams_of(texts)[0]))
        give_back()
        return pa.table({"_chunk": pa.array(np.full(len(found), table.column("_chunk")[0].as_py(), np.int32)), "gram": pa.array(found)})

    def add_up(table: pa.Table, answers: pa.Table) -> pa.Table:
        grams, nats = (answers.column(c).to_numpy() for c in ("gram", "nats"))
        order = np.argsort(grams)
        grams, nats = grams[order], nats[order].astype(np.float64)
        sums, sizes = [], []
        for _, texts in _parts(table.column("_text")):
            asked, n = grams_of(texts)
            unique, place = np.unique(asked, return_inverse=True)
            cost = nats[np.searchsorted(grams, unique)][place]
            sums.append(np.diff(np.concatenate([[0.0], np.cumsum(cost)])[np.concatenate([[0], np.cumsum(n)])]))
            sizes.append(n)
        del answers, grams, nats, order
        give_back()
        kept = [c for name, c in zip(table.column_names, table.columns, strict=True) if name != "_chunk"]
        return pa.table([*kept, pa.array(np.concatenate(sums)), pa.array(np.concatenate(sizes))], names=[*table.column_names[1:], "nats", "n_bytes"])

    # the texts are shuffled once: both plans read the same exchange
    asked = model.costs(marked.groupBy("_chunk").applyInArrow(ask, "_chunk int, gram long"))
    schema = T.StructType([*own.schema.fields, T.StructField("nats", T.DoubleType()), T.StructField("n_bytes", T.LongType())])
    both = marked.groupBy("_chunk").cogroup(asked.groupBy("_chunk")).applyInArrow(add_up, schema)
    place = lambda i, c: F.col("_text" if c == text else f"_kept_{i}").alias(c)
    return both.select(*(place(i, c) for i, c in enumerate(keep)), "nats", "n_bytes")


def classify(documents: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), quantile: float = QUANTILE, margin: float = MARGIN) -> DataFrame:
    """`keep` of documents, with perplexity, drawn_perplexity, threshold (a perplexity too) and rejected.

    Trusted: labels with quality 1 and toxic 0. A document is rejected if its drawn_perplexity, which is its own drawn to its language's
    mean by PRIOR bytes, is above the threshold, or if it has no text.
    """
    bound_batches(documents.sparkSession)
    keep = tuple(c for c in keep if c not in ("perplexity", "drawn_perplexity", "threshold", "rejected"))
    ids = materialize(labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select(F.col("doc_id").alias("_id")).distinct(), "trusted")
    half = F.pmod(F.xxhash64(F.lit(3), F.col("text")), F.lit(2))
    name = lambda i, c: "text" if c == "text" else f"_own_{i}"
    own = documents.select(*(F.col(f"`{c}`").alias(f"_own_{i}") for i, c in enumerate(keep) if c != "text"), "text", F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), half.alias("_half"))
    model = Model(materialize(counts(own.where("length(text) > 0 and _half = 0").select("text", "_id").join(_side(ids), "_id", "left_semi").select("text")), "grams5"))
    scored = materialize(score(own, model, keep=tuple(c for c in own.columns if c != "text" or "text" in keep)), "scored")
    judged = materialize(scored.where("n_bytes > 0 and _half = 1").select("_id", "_lang", "nats", "n_bytes").join(_side(ids), "_id", "left_semi").select("_lang", "nats", "n_bytes"), "judged")
    means = judged.groupBy("_lang").agg((F.sum("nats") / F.sum("n_bytes")).alias("_mean"))
    drawn = lambda: (F.col("nats") + PRIOR * F.col("_mean")) / (F.col("n_bytes") + PRIOR)
    cut = lambda x: F.percentile_approx(x, quantile, 100_000).alias("_least")
    costs = judged.join(means.withColumnRenamed("_lang", "l"), F.col("_lang").eqNullSafe(F.col("l"))).select("_lang", "_mean", drawn().alias("cost"))
    limits = materialize(costs.groupBy(F.col("_lang").alias("_of")).agg(F.first("_mean").alias("_mean"), cut("cost")), "limits")
    everyone = judged.agg((F.sum("nats") / F.sum("n_bytes")).alias("m")).first()["m"]
    least = costs.agg(cut("cost")).first()["_least"]
    known = not model.empty and least is not None
    both = scored.join(_side(limits), F.col("_lang").eqNullSafe(F.col("_of")), "left")
    mean, most = F.coalesce("_mean", F.lit(everyone if known else 0.0)), F.coalesce("_least", F.lit(least if known else 0.0)) + margin
    cost = (F.col("nats") + PRIOR * mean) / (F.col("n_bytes") + PRIOR)
    empty = F.col("n_bytes") == 0
    drawn_cost, limit = F.when(~empty & F.lit(known), F.exp(cost)), F.when(F.lit(known), F.exp(most))
    return both.select(
        *(F.col(name(i, c)).alias(c) for i, c in enumerate(keep)),
        F.when(~empty & F.lit(known), F.exp(F.col("nats") / F.col("n_bytes"))).alias("perplexity"),
        drawn_cost.alias("drawn_perplexity"),
        limit.alias("threshold"),
        F.coalesce(drawn_cost > limit, empty).alias("rejected"),
    )
