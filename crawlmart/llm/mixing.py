"""Mixing sources to target weights by a low-discrepancy schedule.

Each source is a stream of its documents in a shuffled order that depends on the rows alone,
repeated as often as its target asks for. Streams are cut into blocks of equal numbers of
words. Slots 0, 1, 2, … of the mix get van der Corput points (the slot's bits, reversed);
a point falls into one source's stretch of the cumulative numbers of blocks, so the sources
alternate evenly in every part of the mix, and each gets exactly its number of slots. The
n-th slot of a source takes the n-th block of its stream.

Defined results: null text has no words; rows with null source are one source, the last; a
source without words gets nothing; equal rows are placed one after the other, so it does not
matter which is which. An empty table gives an empty mix.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crawlmart import runtime
from crawlmart.llm.common import BLANKS, pinned, restored, running, shelved, words_of
from crawlmart.operators.keyed import number_rows

CELL = 4096  # rows that one task orders together
CHUNK = 1024  # points for which sources are looked up together


@dataclass(frozen=True)
class Mix:
    weights: tuple[float, ...] = (3.0, 1.0, 2.0)  # of the sources in order, repeating
    share: float = 1.5  # words of the whole mix for each word there is
    passes: int = 2  # times that a source can be taken at most
    block: int = 2048  # words


def measure(docs: DataFrame) -> DataFrame:
    """Narrow rows, written once: doc_id, source, size in words, and a hash of the row."""
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    return runtime.materialize(
        docs.select(
            "doc_id",
            "source",
            F.size(words_of(F.col("text"))).cast("long").alias("size"),
            F.xxhash64(*plain).alias("hash"),
        ),
        "sizes",
    )


def targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: id (its place in code point order, null last), source, weight,
    n_rows, source_size, target, quota (whole words) and first and blocks, its stretch of the
    cumulative numbers of blocks.

    A target is the smaller of its cap and level x weight. The level is raised until the
    targets add up; each round needs two sums over the sources.
    """
    sources = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("size").alias("source_size")
    )
    sources = sources.withColumn("missing", F.col("source").isNull())
    numbered = number_rows(sources, ["missing", "source"], "id").drop("missing")
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    weight = F.get(weights, ((F.col("id") - 1) % len(mix.weights)).cast("int"))
    sources = numbered.withColumn("weight", weight).withColumn(
        "cap", F.col("source_size") * float(mix.passes)
    )
    sources = runtime.materialize(sources, "sources")
    level, full = 0.0, None
    while True:
        capped = F.col("cap") <= F.lit(level) * F.col("weight")
        got = sources.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(capped, F.col("cap"))).alias("used"),
            F.count(F.when(capped, True)).alias("full"),
            F.sum(F.when(~capped, F.col("weight"))).alias("open"),
        ).first()
        if not got["open"] or got["full"] == full:
            break
        full = got["full"]
        level = ((got["words"] or 0) * mix.share - (got["used"] or 0.0)) / got["open"]
    target = F.least(F.col("cap"), F.lit(level) * F.col("weight"))
    with_target = sources.withColumn("target", target).withColumn(
        "quota", F.floor("target").cast("long")
    )
    blocks = F.ceil(F.col("quota") / mix.block).cast("long")
    out = with_target.withColumn("blocks", blocks).withColumn(
        "cell", F.floor(F.col("id") / CELL)
    )
    out = running(out.withColumn("all", F.lit(0)), ["all"], "cell", ["id"], "blocks", "first")
    return runtime.materialize(out.drop("all", "cell", "cap"), "targets")


def place(sizes: DataFrame, sources: DataFrame) -> DataFrame:
    """Each row with its source's figures and ``at``, its first word's place in the source's
    shuffled stream. A source is dealt over cells, so that none is ordered in one task."""
    own = sources.select("id", F.col("source").alias("of"), "n_rows", "source_size", "target", "quota")
    rows = sizes.join(own, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    cells = F.ceil(F.col("n_rows") / CELL)
    rows = rows.withColumn("cell", F.pmod("hash", cells))
    return running(rows, ["id"], "cell", ["hash", "doc_id", "size"], "size", "at").drop("cell", "n_rows")


def schedule(sources: DataFrame) -> DataFrame:
    """Slots in order: slot, id of the source, and which slot of this source it is."""
    spark = sources.sparkSession
    total = sources.agg(F.sum("blocks")).first()[0] or 0
    bits = max(1, (total - 1).bit_length())
    point = F.conv(F.reverse(F.lpad(F.bin("slot"), bits, "0")), 2, 10).cast("long")
    slots = (
        spark.range(1 << bits)
        .select(F.col("id").alias("slot"))
        .withColumn("point", point)
        .filter(F.col("point") < total)  # no source's stretch: an empty slot
        .withColumn("chunk", F.floor(F.col("point") / CHUNK))
    )
    last = F.col("first") + F.col("blocks") - 1
    chunks = F.sequence(F.floor(F.col("first") / CHUNK), F.floor(last / CHUNK))
    stretches = sources.filter("blocks > 0").select(
        "id", "first", last.alias("last"), F.explode(chunks).alias("chunk")
    )
    hit = slots.join(stretches, "chunk").filter("point between first and last")
    cell = F.floor(F.col("slot") / CELL)
    hit = hit.select("slot", "id", cell.alias("cell"), F.lit(1).cast("long").alias("one"))
    return running(hit, ["id"], "cell", ["slot"], "one", "block").drop("cell", "one")


def mix_rows(placed: DataFrame, slots: DataFrame, mix: Mix) -> DataFrame:
    """The mix: slot, id, at, hash, doc_id, pass, start (the document's words before the
    piece) and words."""
    begin = F.col("pass") * F.col("source_size") + F.col("at")
    pieces = (
        placed.filter("size > 0")
        .withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(mix.passes - 1))))
        .withColumn("begin", begin)
        .withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("quota")))
        .filter("end > begin")
    )
    block = F.lit(mix.block)
    blocks = F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("end") - 1) / block))
    pieces = pieces.withColumn("block", F.explode(blocks))
    low = F.greatest("begin", F.col("block") * block)
    high = F.least("end", (F.col("block") + 1) * block)
    return pieces.join(slots, ["id", "block"]).select(
        "slot", "id", "at", "hash", "doc_id", "pass",
        (low - F.col("begin")).alias("start"),
        (high - low).alias("words"),
    )


def plan(docs: DataFrame, mix: Mix = Mix()) -> tuple[DataFrame, DataFrame]:
    """(placed rows, rows of the mix) for a table with doc_id, text and source."""
    sizes = measure(docs)
    sources = targets(sizes, mix)
    placed = place(sizes, sources)
    return placed, mix_rows(placed, schedule(sources), mix)


def taken(placed: DataFrame, mixed: DataFrame) -> DataFrame:
    """Each placed row with ``taken``, the words that the mix takes of it, repeats counted, and
    ``first_slot``, where the mix first takes some, or null."""
    got = mixed.groupBy("id", "at").agg(
        F.sum("words").alias("taken"), F.min("slot").alias("first_slot")
    )
    got = got.withColumn("worded", F.lit(True))
    out = placed.withColumn("worded", F.col("size") > 0).join(got, ["id", "at", "worded"], "left")
    return out.withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long")).drop("worded")


def mixed_documents(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The columns of ``docs``: one row for each pass over a document. A document that the
    quota of its source cuts in the middle keeps its first words; n_chars follows the text.

    Texts are shuffled once, by the row's hash. Equal rows are told apart by number only
    after that, so their passes are shared among them.
    """
    placed, mixed = plan(docs, mix)
    passes = mixed.groupBy("hash", "id", "at", "pass").agg(F.sum("words").alias("words"))
    rows = passes.groupBy("hash", "id", "at").agg(F.collect_list("words").alias("passes"))
    rows = rows.groupBy("hash").agg(
        F.sort_array(F.collect_list(F.struct("id", "at", "passes"))).alias("copies")
    )
    plain = [c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    texts, names = shelved(docs)
    old = F.col(names["text"])
    texts = texts.withColumn("hash", F.xxhash64(*[names[c] for c in plain]))
    number = F.row_number().over(Window.partitionBy("hash").orderBy("hash"))
    texts = texts.withColumn("n", number)
    out = texts.join(rows, "hash").select(
        *names.values(), F.explode(F.get("copies", F.col("n") - 1)["passes"]).alias("words")
    )
    out = pinned(out, size=F.size(words_of(old)))
    # All behind the last word that is taken stays in one piece.
    leading = old.rlike("^" + BLANKS).cast("int")
    rest = F.element_at(F.split(old, BLANKS, (F.col("words") + leading + 1).cast("int")), -1)
    cut = F.substring(old, F.lit(1), F.length(old) - F.length(rest))
    text = F.when(F.col("words") >= F.col("size"), old).otherwise(cut)
    return restored(pinned(out, new=text), docs, F.col("new"))
