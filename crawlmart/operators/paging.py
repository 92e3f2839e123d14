"""Page plans, page chains and cut-offs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlmart import runtime

# Request addresses of the crawled site and the ranges of random requests.
POSTS_API = "https://zhuanlan.zhihu.com/api/columns/{slug}/posts?limit=20&offset={offset}"
COLUMN_API = "https://zhuanlan.zhihu.com/api/columns/{slug}"
FOLLOWERS_API = "https://www.zhihu.com/api/v4/members/{slug}/followers?limit=20&offset={offset}"
FOLLOWEES_API = "https://www.zhihu.com/api/v4/members/{slug}/followees?limit=20&offset={offset}"
CONTRIBUTIONS_API = (
    "https://www.zhihu.com/api/v4/members/{slug}/column-contributions?limit=20&offset={offset}"
)
FOLLOWING_API = (
    "https://www.zhihu.com/api/v4/members/{slug}/following-columns?limit=20&offset={offset}"
)
RANDOM_API = (
    "https://zhuanlan.zhihu.com/api/recommendations/columns"
    "?limit={limit}&offset={offset}&seed={seed}"
)
RANDOM_LIMIT = (13, 40)
RANDOM_OFFSET = (0, 100)
RANDOM_SEED = (0, 100)
PAGE_STEP = 20

SEEDS = {
    "follow": {"followers": FOLLOWERS_API, "followees": FOLLOWEES_API},
    "column": {"contributions": CONTRIBUTIONS_API, "following": FOLLOWING_API},
}
CHUNK = 10_000


def fill(template: str, **values: Column) -> Column:
    """Address template with its named places filled by columns."""
    url = F.lit(template)
    for name, value in values.items():
        url = F.replace(url, F.lit("{" + name + "}"), value.cast("string"))
    return url


def offset_plan(columns: DataFrame, total: str = "total", step: int = PAGE_STEP) -> DataFrame:
    """Offsets 0, step, … up to the first one not below the total, with their addresses.

    Page numbers are exploded in two steps, so no single array grows with a large total.
    """
    last = F.ceil(F.greatest(F.col(total), F.lit(0)) / step).cast("long")
    chunks = F.sequence(F.lit(0).cast("long"), "_last", F.lit(CHUNK).cast("long"))
    inside = F.sequence("_from", F.least(F.col("_from") + (CHUNK - 1), "_last"))
    return (
        columns.select("slug", F.coalesce(last, F.lit(0)).cast("long").alias("_last"))
        .select("slug", "_last", F.explode(chunks).alias("_from"))
        .select("slug", F.explode(inside).alias("page"))
        .select("slug", "page", (F.col("page") * step).alias("offset"))
        .withColumn("url", fill(POSTS_API, slug=F.col("slug"), offset=F.col("offset")))
    )


def seed_urls(users: DataFrame, kind: str) -> DataFrame:
    """First-page addresses of each user for one crawl kind, two per user."""
    urls = [
        F.struct(F.lit(name).alias("endpoint"), fill(api, slug=F.col("slug"), offset=F.lit(0)).alias("url"))
        for name, api in SEEDS[kind].items()
    ]
    return users.select("slug", F.explode(F.array(*urls)).alias("s")).select("slug", "s.*")


def random_plan(starts: DataFrame, key: str, n: int = 10, seed: int = 0) -> DataFrame:
    """``n`` random recommendation requests per start; a seed always draws the same ones."""
    drawn = starts.select(key, F.explode(F.sequence(F.lit(1), F.lit(n))).alias("draw"))

    def pick(name: str, bounds: tuple[int, int]) -> Column:
        low, high = bounds
        text = F.concat_ws("|", F.lit(str(seed)), F.lit(name), F.col(key), F.col("draw"))
        number = F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")
        return (low + number % (high - low + 1)).cast("int").alias(name)

    return drawn.select(
        key,
        "draw",
        pick("limit", RANDOM_LIMIT),
        pick("offset", RANDOM_OFFSET),
        pick("seed", RANDOM_SEED),
    ).withColumn(
        "url", fill(RANDOM_API, limit=F.col("limit"), offset=F.col("offset"), seed=F.col("seed"))
    )


def cursor_pages(starts: DataFrame, links: DataFrame) -> DataFrame:
    """(root, url, hop) of every page reached from a start by following ``next_url``.

    ``starts`` has ``url``; ``links`` has ``url`` and ``next_url``. Of a page that was
    fetched several times one link counts, the smallest. Chains are followed by doubling: each round joins the pages reached so far to a table of jumps
    twice as long, so a chain of a million pages takes twenty rounds. A chain that runs
    into itself ends there.
    """
    reached = runtime.materialize(
        starts.select(F.col("url").alias("root"), "url", F.lit(0).cast("long").alias("hop")).distinct(),
        "pages",
    )
    links = links.groupBy("url").agg(F.min("next_url").alias("next_url"))
    jumps = runtime.materialize(links.filter(F.col("next_url").isNotNull()), "jumps")
    step = 1
    while True:
        onward = runtime.lookup(reached, jumps, "url", ["root", "hop"], "inner")
        found = (
            onward.groupBy("root", F.col("next_url").alias("url"))
            .agg(F.min(F.col("hop") + step).alias("hop"))
            .join(reached.select("root", "url"), ["root", "url"], "left_anti")
        )
        path = runtime.new_dir(reached.sparkSession, "pages")
        if runtime.write_counted(found, path) == 0:
            return reached
        found = reached.sparkSession.read.schema(found.schema).parquet(path)
        reached = reached.unionByName(found)
        targets = jumps.select(F.col("url").alias("next_url"), F.col("next_url").alias("_far"))
        jumps = runtime.materialize(
            runtime.lookup(jumps, targets, "next_url", ["url"], "inner").select(
                "url", F.col("_far").alias("next_url")
            ),
            "jumps",
        )
        step *= 2


def until_first_seen(posts: DataFrame, known: DataFrame, key: str = "md5") -> DataFrame:
    """Posts of each column up to and including the page on which a known article appears.

    ``posts`` has column_slug, page (counted from the newest) and the arrival order; pages
    after the cut are dropped whole, a column without known articles is kept whole.
    """
    narrow = posts.select("column_slug", "page", key)
    # A key seen many times on one page says no more than once: shrink before the lookup.
    first = narrow.groupBy("column_slug", key).agg(F.min("page").alias("page"))
    cuts = (
        runtime.lookup(first, known.select(key), key, ["column_slug"], "left_semi")
        .groupBy("column_slug")
        .agg(F.min("page").alias("_cut"))
    )
    return (
        runtime.lookup(posts, cuts, "column_slug", [key, "page"], "left")
        .filter(F.col("page") <= F.coalesce("_cut", "page"))
        .drop("_cut")
    )


def take_pending(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The next ``n`` rows of a work list in a stated order."""
    return df.orderBy(*order).limit(n)
