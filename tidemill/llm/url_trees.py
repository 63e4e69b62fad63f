"""URL filters: rules by host and path, gradient-boosted trees on lexical features for the rest.

Features are the lengths, depth, digit and sign shares, entropy and parameter
counts of a URL, and statistics of its suffixes (last label, last two labels and
whole host, first folder, file suffix): how often labelled URLs with the same
suffix are blocked, and how common it is. Suffixes are hashed into ``BUCKETS``
buckets a kind, so these tables have a fixed size whatever the corpus holds and
may be broadcast; counts are of all labelled rows. Everything is column
expressions, aggregates and Spark ML.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import cut

ALLOW, BLOCK = "allow", "block"

#: Buckets of each kind of suffix.
BUCKETS = 8192
#: Most distinct labelled URLs that the trees are grown on; statistics are of all rows.
SAMPLE_URLS = 10_000
#: Rows that a suffix is taken to have besides its own, with the rate of all.
PRIOR_ROWS = 10
TREES, DEPTH, STEP, SEED = 20, 5, 0.3, 7


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | F.endswith(host, F.lit("." + self.host))) & F.startswith(path, F.lit(self.path))


#: Fixed values of the query's contract.
RULES = (
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
)


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null if none does; of equally long ones, a blocking one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == BLOCK, r.text)):
        fits = rule.fits(host, path)
        text = F.when(fits, rule.text).otherwise(text)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _share(text: Column, signs: str) -> Column:
    """Share of the code points that the character class matches."""
    return F.try_divide(F.length(text) - F.length(F.regexp_replace(text, f"[{signs}]", "")), F.length(text))


def _entropy(text: Column) -> Column:
    """Bits a code point, by the counts of the code points of the text."""
    total = F.octet_length(text)

    def add(sum_, sign):
        n = (total - F.octet_length(F.replace(text, sign, F.lit("")))) / F.octet_length(sign)
        return sum_ + n * F.log2(n)

    n = F.length(text)
    return F.when(n > 0, F.log2(n.cast("double")) - F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), add) / n)


def lexical_features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Features of the URL's own text. A null or empty URL has zeros."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    features = {
        "length": F.length(url), "host_length": F.length(host), "path_length": F.length(path),
        "labels": F.size(F.split(host, r"\.")), "depth": F.size(F.filter(F.split(path, "/"), lambda part: part != "")),
        "folder_end": F.endswith(path, F.lit("/")).cast("int"), "query_length": F.length(query),
        "parameters": F.size(F.filter(F.split(query, "&"), lambda part: part != "")), "fragment": F.contains(url, F.lit("#")).cast("int"),
        "secure": F.startswith(F.lower(url), F.lit("https:")).cast("int"),
        "digits": _share(url, "0-9"), "path_digits": _share(path, "0-9"), "signs": _share(url, r"\-_.~%@"),
        "upper": _share(path, "A-Z"), "entropy": _entropy(url), "host_entropy": _entropy(host),
    }
    return {name: F.coalesce(column.cast("double"), F.lit(0.0)) for name, column in features.items()}


def suffixes(host: Column, path: Column) -> dict[str, Column]:
    """Parts of a URL whose labels are counted."""
    return {
        "top": F.substring_index(host, ".", -1), "site": F.substring_index(host, ".", -2), "host": host,
        "folder": F.regexp_extract(path, r"^/([^/]*)/", 1), "file": F.regexp_extract(path, r"\.([A-Za-z0-9]{1,8})$", 1),
    }


KINDS = ("top", "site", "host", "folder", "file")


def _prepared(urls: DataFrame) -> DataFrame:
    """``urls`` (with ``url``) and host, path, bucket numbers and lexical features."""
    split = urls.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    host, path = F.col("host"), F.col("path")
    buckets = {f"b_{kind}": F.pmod(F.xxhash64(value), F.lit(BUCKETS)) for kind, value in suffixes(host, path).items()}
    return split.withColumns({**buckets, **{f"x_{name}": c for name, c in lexical_features(F.col("url"), host, path).items()}})


def _half() -> Column:
    return F.pmod(F.xxhash64("url", F.lit("half")), F.lit(2))


@dataclass(frozen=True)
class UrlModel:
    """Trees, suffix statistics (``kind, bucket``, rows and blocked rows in each half of the labelled URLs; at most
    ``BUCKETS`` rows a kind) and totals. Without trees, every URL gets ``constant``."""

    trees: GBTClassificationModel | None
    statistics: DataFrame | None
    rows: tuple[int, int]
    blocked: tuple[int, int]
    constant: str


def _with_statistics(urls: DataFrame, statistics: DataFrame, rows, blocked, own_half: Column) -> DataFrame:
    """Adds rates and shares of each suffix; a training row sees the other half of the labelled rows only."""
    for kind in KINDS:
        table = statistics.where(F.col("kind") == kind).drop("kind")
        urls = urls.join(F.broadcast(table.withColumnRenamed("bucket", f"b_{kind}")), f"b_{kind}", "left")

        def seen(name, totals):
            use = [F.when(own_half == half, 0).otherwise(1) for half in (0, 1)]
            own = sum((F.coalesce(F.col(f"{name}{half}"), F.lit(0)) * use[half] for half in (0, 1)), F.lit(0))
            return own, sum((F.lit(totals[half]) * use[half] for half in (0, 1)), F.lit(0))

        (n, all_n), (b, all_b) = seen("n", rows), seen("b", blocked)
        rate = (b + PRIOR_ROWS * F.try_divide(all_b, all_n)) / (n + PRIOR_ROWS)
        urls = urls.withColumns({
            f"x_rate_{kind}": F.coalesce(rate, F.lit(0.5)), f"x_share_{kind}": F.log2((n + 1.0) / (all_n + 1.0)),
        }).drop("n0", "n1", "b0", "b1")
    return urls


def _assembled(urls: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[c for c in urls.columns if c.startswith("x_")], outputCol="features").transform(urls)


def learn(labelled: DataFrame, sample: int = SAMPLE_URLS) -> UrlModel:
    """Model of labelled URLs: ``url`` and boolean ``blocked``; rows with a null in either teach nothing.

    Suffix statistics count every row. Trees grow on at most ``sample`` distinct URLs, the first by hash (a URL with both
    labels counts as blocked): rows above a hash bound go before any row is sent, so the sample's size does not depend on
    the number of tasks. With labels of one kind only, all URLs get that verdict; without labels, they are allowed.
    """
    labelled = labelled.where("url is not null and blocked is not null").select("url", F.col("blocked").cast("int").alias("b"))
    keyed = _prepared(labelled).withColumn("half", _half())
    kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(f"b_{kind}").alias("bucket")) for kind in KINDS])

    def count(half, value):
        return F.sum(F.when(F.col("half") == half, value).otherwise(0))

    statistics = cut(
        keyed.select("half", "b", F.inline(kinds)).groupBy("kind", "bucket")
        .agg(count(0, 1).alias("n0"), count(1, 1).alias("n1"), count(0, F.col("b")).alias("b0"), count(1, F.col("b")).alias("b1"))
    )
    # Every row is counted once per kind.
    sums = statistics.where(F.col("kind") == KINDS[0]).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n0", "n1", "b0", "b1")]).first()
    rows, blocked = (sums["n0"], sums["n1"]), (sums["b0"], sums["b1"])
    if not 0 < sum(blocked) < sum(rows):
        return UrlModel(None, None, rows, blocked, BLOCK if sum(blocked) else ALLOW)
    distinct = labelled.agg(F.approx_count_distinct("url")).first()[0]
    order = F.xxhash64("url", F.lit("sample"))
    bound = min(1.0, 1.3 * sample / distinct)
    chosen = (
        labelled.where(F.pmod(order, F.lit(1 << 30)) < int(bound * (1 << 30)))
        .groupBy("url").agg(F.max("b").alias("label")).orderBy(F.pmod(order, F.lit(1 << 30)), "url").limit(sample)
    )
    training = _prepared(chosen).withColumn("half", _half())
    training = _assembled(_with_statistics(training, statistics, rows, blocked, F.col("half")))
    # One sorted part of bounded size: sums, and so the trees, come out the same on any cluster.
    training = cut(training.select("url", "features", F.col("label").cast("double").alias("label")).repartition(1).sortWithinPartitions("url"))
    if training.agg(F.count_distinct("label")).first()[0] < 2:
        return UrlModel(None, None, rows, blocked, BLOCK if 2 * sum(blocked) > sum(rows) else ALLOW)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, maxMemoryInMB=256).fit(training.select("features", "label"))
    return UrlModel(trees, statistics, rows, blocked, ALLOW)


def judge(pages: DataFrame, model: UrlModel, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` per row of ``pages``.

    ``rule`` is the text of the longest fitting rule, and its verdict holds; else the trees decide. ``score`` is their
    chance of a block (null without trees). A URL that is null or without ``://`` has an empty host and path, so no rule
    fits and the trees judge its other features. Every row gets its own result, repeated rows equal ones; columns other
    than page_id and url are ignored whatever their names; an empty table gives an empty one. Nothing is shuffled.
    """
    pages = pages.select("page_id", "url")
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    if model.trees is None:
        split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        verdict, score = F.lit(model.constant), F.lit(None).cast("double")
    else:
        ready = _with_statistics(_prepared(pages), model.statistics, model.rows, model.blocked, F.lit(None).cast("int"))
        split = model.trees.transform(_assembled(ready))
        verdict = F.when(F.col("prediction") > 0.5, BLOCK).otherwise(ALLOW)
        score = F.get(vector_to_array("probability"), F.lit(1))
    return split.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(by_rule, verdict).alias("verdict"), score.alias("score"))


def labelled_by_rules(pages: DataFrame, rules=RULES) -> DataFrame:
    """``url, blocked`` of the pages that a rule decides."""
    url = F.col("url")
    split = pages.select("url", host_of(url).alias("host"), path_of(url).alias("path"))
    _, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return split.select("url", (verdict == BLOCK).alias("blocked")).where("blocked is not null")
