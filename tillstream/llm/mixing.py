"""Mixing sources to target weights by raking.

Documents fall into cells of source, language and topic. Iterative proportional
fitting scales the cells' tokens until the shares of every source, language and
topic equal the targets; the fitted cell over the cell's own tokens, scaled to
the wanted total, is the probability with which each of its documents is drawn.
Everything is DataFrame work: the documents are read for the cells' sums and
for the drawing, and the fitting goes over the table of cells alone.

Targets are shares by value for any of the three; without one, the corpus's own
shares to a power below 1 (after normalising), so that small sources gain. A
missing source, language or topic is a value of its own, "(none)". Values that
the targets do not list are left out (probability 0); listed values that the
corpus lacks are ignored, and shares are normalised over what is left.

No probability exceeds 1: what a cell cannot give is spread over the others in
proportion, until the expected total is reached or everything is taken.

Tokens are words between ASCII white space; a null or empty text has none and
is drawn with its cell's probability (1 in a cell without any token, if its
values are listed). The draw of a document depends on its doc_id and text
alone, so repeated rows are drawn together.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.common import materialize, set_aside, unit_interval

DIMENSIONS = ("source", "lang", "topic")
MISSING = "(none)"

#: Markers by topic, as plain text; a document's topic has the most of them for
#: each of their kinds, the first listed among equals, and prose has none.
TOPICS: dict[str, list[str]] = {
    "legal": ["License", "license", "Copyright"],
    "table": [" | "],
    "symbols": ["###", "$$$", "%%%", "&&&", "***"],
    "contact": ["@", "+1 ("],
    "credentials": ["token = ", "password"],
}
REST = "prose"
CELL = ("_source", "_lang", "_topic")


def topic_of(text: Column, topics: Mapping[str, list[str]] = TOPICS) -> Column:
    """The topic whose markers a text holds most often."""
    text = F.coalesce(text, F.lit(""))

    def hits(marker: str) -> Column:
        left = F.length(F.replace(text, F.lit(marker), F.lit("")))
        return (F.length(text) - left) / len(marker)

    counts = [
        F.struct(
            sum((hits(m) for m in markers), F.lit(0.0)).alias("hits"),
            F.lit(-place).alias("place"),
            F.lit(topic).alias("topic"),
        )
        for place, (topic, markers) in enumerate(topics.items())
    ]
    if not counts:
        return F.lit(REST)
    best = F.greatest(*counts) if len(counts) > 1 else counts[0]
    return F.when(best["hits"] > 0, best["topic"]).otherwise(REST)


def token_count(text: Column) -> Column:
    """Words between ASCII white space: the places where one begins."""
    text = F.coalesce(text, F.lit(""))
    gaps, marks = "\t\n\x0b\x0c\r", "     "
    plain = F.translate(text, gaps, marks)
    parts = F.split(plain, " +")
    blank = F.when(F.startswith(plain, F.lit(" ")), 1).otherwise(0) + F.when(
        F.endswith(plain, F.lit(" ")), 1
    ).otherwise(0)
    return F.when(F.trim(plain) == "", 0).otherwise(F.size(parts) - blank).cast("long")


def with_cells(docs: DataFrame, topics: Mapping[str, list[str]] = TOPICS) -> DataFrame:
    """Columns _source, _lang, _topic, _tokens and _draw, a number in (0, 1).

    A column ``topic`` of the documents' own is used.
    """
    topic = F.col("topic").cast("string") if "topic" in docs.columns else topic_of(F.col("text"), topics)
    named = {
        "_source": F.coalesce(F.col("source").cast("string"), F.lit(MISSING)),
        "_lang": F.coalesce(F.col("lang").cast("string"), F.lit(MISSING)),
        "_topic": F.coalesce(topic, F.lit(MISSING)),
        "_tokens": token_count(F.col("text")),
        "_draw": unit_interval(
            F.concat_ws(":", F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")))),
            "mixing",
        ),
    }
    return docs.withColumns(named)


def cell_totals(docs: DataFrame) -> DataFrame:
    """Tokens and rows of each cell of ``with_cells``."""
    return docs.groupBy(*CELL).agg(F.sum("_tokens").alias("tokens"), F.count("*").alias("rows"))


def _with_target(
    cells: DataFrame, name: str, shares: Mapping[str, float] | None, power: float
) -> DataFrame:
    """``cells`` whose value is wanted, with its target share."""
    own = cells.groupBy(f"_{name}").agg(F.sum("tokens").alias("own")).filter("own > 0")
    if shares is None:
        own = own.withColumn("wanted", F.pow(F.col("own").cast("double"), power))
    else:
        pairs = [F.lit(x) for value, share in shares.items() for x in (value, float(share))]
        wanted = F.create_map(*pairs)[F.col(f"_{name}")] if pairs else F.lit(None).cast("double")
        own = own.withColumn("wanted", wanted).filter("wanted > 0")
    total = own.agg(F.sum("wanted")).first()[0] or 1.0
    target = own.select(f"_{name}", (F.col("wanted") / total).alias(f"target_{name}"))
    return cells.join(target, f"_{name}")


def rake(
    cells: DataFrame,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    power: float = 0.5,
    rounds: int = 30,
    tolerance: float = 1e-3,
) -> DataFrame:
    """Cells with their fitted share ``weight``; cells without a target are left out.

    Stops when no share is off by more than ``tolerance``, or after ``rounds``:
    targets that exclude each other have no exact fit.
    """
    fitted = cells
    for name in DIMENSIONS:
        fitted = _with_target(fitted, name, (targets or {}).get(name), power)
    fitted = fitted.withColumn("weight", F.col("tokens").cast("double"))
    for _ in range(rounds):
        fitted = fitted.withColumn("off", F.lit(0.0))
        for name in DIMENSIONS:
            own = F.sum("weight").over(Window.partitionBy(f"_{name}"))
            wanted = F.col(f"target_{name}")
            fitted = fitted.withColumn("own", own).withColumns(
                {
                    "off": F.greatest("off", F.abs(F.col("own") - wanted)),
                    "weight": F.when(F.col("own") > 0, F.col("weight") * wanted / F.col("own"))
                    .otherwise(0.0),
                }
            )
        fitted = materialize(fitted.drop("own"))
        if (fitted.agg(F.max("off")).first()[0] or 0.0) <= tolerance:
            break
    return fitted.select(*CELL, "tokens", "rows", "weight")


def calibrate(fitted: DataFrame, tokens: float) -> DataFrame:
    """``probability`` of each fitted cell's documents for an expected total of ``tokens``.

    The scale is found by rounds of sums: cells that would give more than they
    have give all, the others share the rest, until no cell joins the first.
    """
    needed, scale = F.col("weight") / F.greatest(F.col("tokens"), F.lit(1)), float(tokens)
    full = -1
    while True:
        capped = needed * scale >= 1
        sums = fitted.agg(
            F.sum(F.when(capped, F.col("tokens"))).alias("given"),
            F.sum(F.when(~capped, F.col("weight"))).alias("rest"),
            F.count_if(capped).alias("full"),
        ).first()
        if sums.full <= full or not sums.rest:
            break
        full = sums.full
        scale = max(scale, (tokens - (sums.given or 0)) / sums.rest)
    probability = F.when(F.col("tokens") == 0, 1.0).otherwise(F.least(needed * scale, F.lit(1.0)))
    return fitted.withColumn("probability", probability)


def mix(
    placed: DataFrame,
    share: float = 0.5,
    targets: Mapping[str, Mapping[str, float]] | None = None,
    power: float = 0.5,
) -> DataFrame:
    """Rows of ``with_cells`` with their weight and probability, and whether they are drawn.

    Columns of the names ``weight``, ``probability`` and ``drawn`` are replaced.

    ``share``: expected tokens drawn, as a share of all tokens.
    """
    placed = placed.drop("weight", "probability", "drawn")
    cells = materialize(cell_totals(placed))
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    drawn = materialize(calibrate(rake(cells, targets, power), share * total))
    return (
        placed.join(drawn.select(*CELL, "weight", "probability"), list(CELL), "left")
        .withColumn("probability", F.coalesce("probability", F.lit(0.0)))
        .withColumn("drawn", F.col("_draw") < F.col("probability"))
    )


def draw(docs: DataFrame, topics: Mapping[str, list[str]] = TOPICS, **options) -> DataFrame:
    """The drawn documents, with their own columns only."""
    plain, back = set_aside(docs, ("doc_id", "text", "source", "lang", "topic"))
    return mix(with_cells(plain, topics), **options).filter("drawn").select(*back)
