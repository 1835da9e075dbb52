"""URL filter: allow and block rules, then logistic regression on character n-grams.

The model is trained from a small labelled table of URLs on hashed character n-grams of
host and path. The weights are a sum of the labelled examples, w = sum_i alpha_i x_i, as
every step of gradient descent from zero adds multiples of examples; so the descent runs
on alpha and the examples' products with each other, and needs neither a job per step nor
a trip to the driver. Everything is DataFrame work, and judging a URL moves no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinflat.llm.texts import ascii_lower

GRAMS = (3, 4, 5)
BUCKETS = 4096
STEPS = 200
RATE = 2.0
DECAY = 0.002
MAX_LABELLED = 500  # labelled URLs used; of more, those with the smallest hash


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` in lower case, path up to ``?`` or ``#``; else empty."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    none = F.lit("")
    has = F.coalesce(at > 0, F.lit(False))
    return F.when(has, ascii_lower(host)).otherwise(none), F.when(has, path).otherwise(none)


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of the (verdict, ``host/path``) rules that fits, and its verdict, or nulls.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    fits = []
    for verdict, rule in rules:
        name, _, rest = rule.partition("/")
        same = (host == name) | host.endswith("." + name)
        row = F.struct(
            F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")
        )
        fits.append(F.when(same & path.startswith("/" + rest), row))
    if not fits:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    best = F.array_max(F.array(*fits))
    return best["rule"], best["verdict"]


def features(host: Column, path: Column) -> Column:
    """Distinct hash buckets of the character n-grams of ``^host$`` and of the path."""
    marked = {"h": F.concat(F.lit("^"), host, F.lit("$")), "p": F.concat(F.lit("/"), path)}

    def grams(kind: str, n: int) -> Column:
        text = marked[kind]
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - n + 1, F.lit(1)))
        return F.transform(starts, lambda k: F.concat(F.lit(kind), F.substring(text, k, n)))

    hashed = F.transform(
        F.concat(*[grams(kind, n) for n in GRAMS for kind in marked]),
        lambda g: (F.conv(F.substring(F.md5(g), 1, 8), 16, 10).cast("long") % BUCKETS).cast("int"),
    )
    return F.array_distinct(hashed)


def train(
    labelled: DataFrame, url_col: str = "url", label_col: str = "blocked",
    max_labelled: int = MAX_LABELLED,
) -> DataFrame:
    """One row: ``weights`` (array of BUCKETS doubles) and ``bias``.

    ``labelled`` has a URL and 1 (block) or 0 (allow); rows without either are left out,
    repeated rows count once. At most ``max_labelled`` URLs are used, chosen by hash.
    Without any, all weights are zero.
    """
    host, path = host_and_path(labelled[url_col])
    rows = (
        labelled.select(
            labelled[url_col].alias("url"), labelled[label_col].cast("double").alias("y"),
            features(host, path).alias("x"),
        )
        .where("url is not null and y is not null")
        .dropDuplicates(["url", "y"])
        .orderBy(F.md5("url"), "url", "y")
        .limit(max_labelled)
    )
    row = F.struct(F.md5("url").alias("k"), "url", "y", "x")
    one = rows.agg(F.array_sort(F.collect_list(row)).alias("rows"))
    size = lambda r: F.sqrt(F.size(r["x"]).cast("double"))
    products = F.transform(
        "rows",
        lambda r: F.transform(
            "rows",
            lambda q: F.size(F.array_intersect(r["x"], q["x"])) / (size(r) * size(q)),
        ),
    )
    zero = F.lit(0.0)
    one = one.select("rows", products.alias("products"), F.greatest(F.size("rows"), F.lit(1)).alias("n"))
    dot = lambda u, v: F.aggregate(
        F.zip_with(u, v, lambda p, q: p * q), zero, lambda s, t: s + t
    )

    def step(s: Column, _: Column) -> Column:
        error = F.zip_with(
            "rows", "products",
            lambda r, p: r["y"] - 1 / (1 + F.exp(-(dot(p, s["alpha"]) + s["bias"]))),
        )

        def moved(e: Column) -> Column:
            alpha = F.zip_with(
                s["alpha"], e, lambda a, g: a * (1 - RATE * DECAY) + RATE / F.col("n") * g
            )
            shift = F.aggregate(e, zero, lambda t, g: t + g) * RATE / F.col("n")
            return F.struct(alpha.alias("alpha"), (s["bias"] + shift).alias("bias"))

        # a list of one holds the errors, so that both updates use one computation
        return F.get(F.transform(F.array(error), moved), 0)

    start = F.struct(F.transform("rows", lambda r: zero).alias("alpha"), zero.alias("bias"))
    fit = F.aggregate(F.sequence(F.lit(0), F.lit(STEPS)), start, step)
    one = one.select("rows", fit.alias("fit"))
    shares = F.zip_with(
        "rows", F.col("fit")["alpha"],
        lambda r, a: F.struct((a / size(r)).alias("share"), r["x"].alias("x")),
    )
    learned = one.select(F.inline(shares)).select("share", F.explode("x").alias("bucket"))
    weights = learned.groupBy("bucket").agg(F.sum("share").alias("weight"))
    every = labelled.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    dense = every.join(F.broadcast(weights), "bucket", "left").agg(
        F.array_sort(
            F.collect_list(F.struct("bucket", F.coalesce("weight", zero).alias("weight")))
        ).alias("cells")
    )
    bias = one.select(F.col("fit")["bias"].alias("bias"))
    return dense.select(
        F.transform("cells", lambda c: c["weight"]).alias("weights"), bias.scalar().alias("bias")
    )


def judge(
    pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str]],
    id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, score``, a row for each input row.

    ``verdict`` is the rule's, else ``block`` where the model's probability ``score`` is
    over one half, else ``allow``. A null URL, or one without ``://``, has an empty host
    and path and is judged like any other. Repeated rows are judged alike; other columns
    are not read.
    """
    model = train(labelled)
    host, path = host_and_path(pages[url_col])
    rows = pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns(
        {"rule": rule, "ruled": verdict, "x": features(F.col("host"), F.col("path")),
         "weights": model.select("weights").scalar(), "bias": model.select("bias").scalar()}
    )
    total = F.aggregate("x", F.lit(0.0), lambda s, k: s + F.get(F.col("weights"), k))
    margin = total / F.sqrt(F.size("x").cast("double")) + F.col("bias")
    scored = rows.withColumn("score", 1 / (1 + F.exp(-margin)))
    own = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "score"
    )
