"""URL verdicts: written rules first, then logistic regression on hashed character n-grams.

A rule names a host and a path prefix and fits that host and its subdomains; the longest
fitting rule decides. Where none fits, a model judges: n-grams of three to five characters
of host and path are hashed to a fixed width and weighed by a logistic regression that is
fitted on a small labelled table: any table of (url, label), or ``labelled_urls``. All of it
runs as Spark columns and pyspark.ml, so the table may also be a large one.

Defined cases: a null url, or one without ``://``, has an empty host and path, no rule, and
the verdict of a URL without n-grams. An empty table gives no rows. Labels other than ``allow``
and ``block`` are left out; with none of one of the two, all other urls get the label there is, and
``allow`` without any. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitval.llm.common import read

ALLOW, BLOCK = "allow", "block"
#: (rule as host and path in one string, verdict).
RULES = [
    ("com/", ALLOW),
    ("example.com/en/", BLOCK),
    ("www.example.com/en/", ALLOW),
    ("net/es/", BLOCK),
    ("net/fr/", BLOCK),
]
SIZES = (3, 4, 5)
WIDTH = 1 << 16

#: Labelled hosts, each combined with the paths of its label: the training table.
BLOCKED_HOSTS = [
    "casino-win.test", "best-casino.test", "online-casino.test", "free-bets.test", "sports-bets.test", "poker-free.test",
    "cheap-pills.test", "pills-shop.test", "buy-pills.test", "ads-track.test", "ads-server.test", "click-track.test",
    "spam-farm.test", "link-farm.test", "seo-spam.test", "adult-x.test", "adult-cams.test", "xxx-adult.test",
    "free-cash.test", "win-prize.test",
]
BLOCKED_PATHS = ["/bonus/1", "/free/win", "/buy/pills.html", "/en/12", "/de/7/"]
ALLOWED_HOSTS = [
    "news.test", "blog.garden.test", "www.library.test", "m.weather.test", "history.test", "docs.manual.test",
    "www.museum.test", "recipes.test", "science.test", "blog.travel.test", "school.test", "music-notes.test",
    "city-council.test", "www.journal.test", "maps.test", "forum.bikes.test", "lake-house.test", "thing.test",
    "wiki.test", "m.radio.test",
]
ALLOWED_PATHS = ["/en/12", "/de/7/", "/article/1.html", "/2020/05/notes", "/about"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host with A-Z lower-cased, and the path; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(host, capitals, capitals.lower())
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for text, verdict in sorted(rules, key=lambda r: len(r[0])):
        own, slash, prefix = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(slash + prefix))
        found = F.when(fits, F.struct(F.lit(text).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _cut(text: Column, size: int) -> Callable[[Column], Column]:
    return lambda i: F.substr(text, i, F.lit(size))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path; none for two empty ones."""
    text = F.concat(F.lit("^"), host, path)
    parts = []
    for size in SIZES:
        last = F.length(text) - size + 1
        parts.append(
            F.when(
                (last >= 1) & ((host != "") | (path != "")),
                F.transform(F.sequence(F.lit(1), last), _cut(text, size)),
            ).otherwise(F.array().cast("array<string>"))
        )
    return F.concat(*parts)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The table that is used if none is given: 200 rows of (url, label)."""
    rows = [(f"http://{h}{p}", BLOCK) for h in BLOCKED_HOSTS for p in BLOCKED_PATHS]
    rows += [(f"http://{h}{p}", ALLOW) for h in ALLOWED_HOSTS for p in ALLOWED_PATHS]
    return spark.createDataFrame(rows, "url string, label string").coalesce(1)


def train(labelled: DataFrame) -> PipelineModel | str:
    """Hashing and regression, fitted on (url, label); the only label if there is but one."""
    rows = labelled.where(F.col("label").isin(ALLOW, BLOCK))
    labels = sorted(r["label"] for r in rows.select("label").distinct().collect())
    if len(labels) < 2:
        return labels[0] if labels else ALLOW
    host, path = host_and_path(F.col("url").cast("string"))
    table = rows.select(host.alias("host"), path.alias("path"), (F.col("label") == BLOCK).cast("double").alias("label"))
    hashing = HashingTF(numFeatures=WIDTH, binary=True, inputCol="grams", outputCol="features")
    made = hashing.transform(table.withColumn("grams", grams(F.col("host"), F.col("path"))))
    model = LogisticRegression(regParam=0.01, maxIter=50).fit(made)
    return PipelineModel([hashing, model])


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and the model's chance of ``block`` for every row."""
    host, path = host_and_path(F.col("url").cast("string"))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    model = train(labelled_urls(pages.sparkSession) if labelled is None else labelled)
    if isinstance(model, str):
        scored, by_model, chance = parts, F.lit(model), F.lit(float(model == BLOCK))
    else:
        scored = model.transform(parts.withColumn("grams", grams(F.col("host"), F.col("path"))))
        by_model = F.when(F.col("prediction") == 1.0, BLOCK).otherwise(ALLOW)
        chance = vector_to_array("probability")[1]
    found = matching_rule(F.col("host"), F.col("path"), rules)
    return scored.withColumn("found", found).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), by_model).alias("verdict"), chance.alias("block_chance"),
    )


def op8(spark, folder):
    return judge(read(spark, folder, "pages"))
