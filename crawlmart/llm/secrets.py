"""Secret scans with linking of multipart credentials.

Patterns find spans in whole texts. Three kinds are reported as they are: assignments, access
identifiers and long hexadecimal runs. Three more are too weak alone: other identifiers,
secret-like runs, and endpoints. An interval join of all spans within a scope, a distance in
the same text, reports a weak one only where its complementary parts stand.

Positions come from the lengths of what a pattern leaves and takes, added up per text after
both are exploded into rows, so a text with very many matches costs no more per match.

Defined results: null text is empty; equal rows get equal results; rows are recognised by a
64-bit hash of doc_id and text; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crawlmart import runtime


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    least: int  # characters of the whole match, or of its first group
    group: bool = False
    needs: tuple[tuple[str, ...], ...] = ()  # of each tuple one kind must stand in the scope


VALUE = r"[A-Za-z0-9+/_.=-]+"
RUN = r"[A-Za-z0-9+/_-]"
IDENT, SECRET = ("access", "ident"), ("secret", "hex", "assign")
KINDS = (
    Kind(
        "assign",
        rf"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?({VALUE})""",
        8,
        group=True,
    ),
    Kind("access", "AKIA[A-Z0-9]+", 16),
    Kind("hex", "[0-9a-f]{32,}", 32),  # a run of [0-9a-f] is never cut, so its least is known
    Kind(
        "ident",
        r"""(?i:access_?key(?:_?id)?|client_?id|account_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]+""",
        8,
        needs=(("secret", "hex"),),
    ),
    Kind(
        "secret",
        # Not behind a dot, and no "//": those are hosts, files and their paths.
        rf"(?<![A-Za-z0-9+/_.-])(?!//)(?={RUN}*[A-Z])(?={RUN}*[a-z])(?={RUN}*[0-9]){RUN}{{20,}}={{0,2}}",
        20,
        needs=(IDENT,),
    ),
    Kind(
        "endpoint",
        r"(?:https?|s3|jdbc:[a-z]+|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&'()*+,;=%-]+",
        10,
        needs=(IDENT, SECRET),
    ),
)
BASE = tuple(k.name for k in KINDS if not k.needs)
SCOPE = 400  # code points between the end of a part and the start of one that belongs to it


def _hits(text: Column, kind: Kind) -> Column:
    """For each match: code points before it since the last one, its own, and whether it is
    long enough."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    between = F.split(text, kind.pattern, -1)

    def hit(match: Column, gap: Column) -> Column:
        value = F.regexp_extract(match, kind.pattern, 1) if kind.group else match
        return F.struct(
            F.length(gap).alias("gap"),
            F.length(match).alias("size"),
            (F.length(value) >= kind.least).alias("ok"),
        )

    # One gap more than there are matches: the last pair has no match and is cut off.
    pairs = F.zip_with(found, between, hit)
    return F.when(text.rlike(kind.pattern), F.filter(pairs, lambda x: x["size"].isNotNull()))


def spans(docs: DataFrame) -> DataFrame:
    """key, kind, start, end (code points, end exclusive) of all spans, weak ones included,
    written once. ``docs`` has key and text."""
    named = [F.struct(F.lit(k.name).alias("kind"), _hits(F.col("text"), k).alias("hits")) for k in KINDS]
    rows = docs.select("key", F.explode(F.array(*named)).alias("k"))
    rows = rows.select("key", "k.kind", F.posexplode("k.hits").alias("i", "hit"))
    rows = rows.select("key", "kind", "i", "hit.*").dropDuplicates(["key", "kind", "i"])
    so_far = Window.partitionBy("key", "kind").orderBy("i")
    upto = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(upto)
    rows = rows.withColumn("end", end).filter("ok")
    return runtime.materialize(
        rows.select("key", "kind", (F.col("end") - F.col("size")).alias("start"), "end"), "spans"
    )


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak spans whose complementary parts stand within ``scope``.

    Parts lie in all bins of the width of the scope that they touch, a weak span looks into
    those that it and the scope around it touch. A bin holds few spans, as spans of a kind do
    not overlap, so no bin is hot, and a text gives no more bins than its length over scope."""
    weak = found.filter(~F.col("kind").isin(*BASE))

    def bins(low: Column, high: Column) -> Column:
        return F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope)))

    looks = weak.withColumn("bin", bins(F.col("start") - scope, F.col("end") + scope))
    parts = found.select(
        F.col("key"),
        bins(F.col("start"), F.col("end")).alias("bin"),
        F.col("kind").alias("part"),
        F.col("start").alias("from"),
        F.col("end").alias("to"),
    )
    near = F.greatest("start", "from") - F.least("end", "to") <= scope
    pairs = looks.join(parts, ["key", "bin"]).filter(near)
    by = pairs.groupBy("key", "kind", "start", "end").agg(F.collect_set("part").alias("parts"))
    enough = F.lit(False)
    for kind in KINDS:
        if kind.needs:
            has = F.lit(True)
            for some in kind.needs:
                has = has & F.arrays_overlap("parts", F.array(*[F.lit(x) for x in some]))
            enough = enough | ((F.col("kind") == kind.name) & has)
    return by.filter(enough).select("key", "kind", "start", "end")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, key and base and all: arrays of (start, rank of the kind, end, kind), by start
    and then kind."""
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    found = spans(docs)
    known = found.filter(F.col("kind").isin(*BASE)).unionByName(linked(found))
    names = F.array(*[F.lit(k.name) for k in KINDS])
    one = F.struct("start", F.array_position(names, F.col("kind")).alias("rank"), "end", "kind")
    by = known.groupBy("key").agg(F.sort_array(F.collect_list(one)).alias("all"))
    none = F.array().cast("array<struct<start:bigint,rank:bigint,end:bigint,kind:string>>")
    out = docs.select("doc_id", "key").join(by, "key", "left")
    out = out.withColumn("all", F.coalesce("all", none))
    return out.withColumn("base", F.filter("all", lambda s: s["rank"] <= len(BASE)))


def written(spans_: Column | str) -> Column:
    """kind:start:end, comma-joined."""
    text = F.transform(
        spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(text, ",")
