"""Mixing sources to target weights by iterative proportional fitting; DataFrame functions only.

Documents are counted into cells (source, language, topic) by tokens. The cells' weights start at their
tokens and are raked: in turn, each dimension's weights are scaled to its target shares, until the last
of ``rounds`` rounds. A document's probability is its cell's weight over its tokens, times one factor
for all cells that makes the expected number of tokens ``budget`` times what there is; probabilities end
at 1 and the factor makes up for it. Each document is drawn by a uniform number from its id's hash.

A dimension's target shares are given per value, or follow its own shares raised to a power (below 1
flattens the mix). Values without a given share keep none. All cells are tables: any number of sources
or languages fits, and nothing but one row of sums comes to the driver per step.

Defined cases: a null text has no tokens; documents without tokens have probability 1 (they weigh
nothing); a null source, language or topic is a value of its own, the text ``(none)``; repeated rows
with one id are drawn together, null ids by the hash of the text ``(none)``; a cell whose target is 0
has probability 0; further columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import tidy, whole

NONE = "(none)"
HEX_DIGITS = 13  # 52 bits: exact in a double


def tokens(text: Column | str) -> Column:
    """Runs of characters that are not ASCII white space."""
    return F.regexp_count(whole(text), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint")


def form_of(text: Column | str) -> Column:
    """A topic for texts that bring none: what form they have, told by the share of some characters."""
    t = whole(text)
    n = F.greatest(F.length(t), F.lit(1))
    share = lambda chars: F.lit(0) + sum((F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))) for c in chars)
    return (
        F.when(share("|") * 100 >= n, "table").when(share("$%&#*!") * 100 >= n * 3, "marked").when(share("0123456789") * 100 >= n, "figures").otherwise("prose")
    )


def draw(doc_id: Column | str, seed: str) -> Column:
    """A number in [0, 1) for an id."""
    text = F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(NONE))
    digest = F.md5(F.concat(text, F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("double") / F.lit(float(16**HEX_DIGITS))


def _targets(cells: DataFrame, dim: str, target: Mapping[str, float] | float) -> DataFrame:
    """(value, share) of a dimension."""
    if isinstance(target, Mapping):
        rows = [F.struct(F.lit(str(k)).alias(dim), F.lit(float(v)).alias("power")) for k, v in target.items()]
        there = cells.select(dim).distinct().join(cells.sparkSession.range(1).select(F.inline(F.array(*rows))), dim)
    else:
        there = cells.groupBy(dim).agg(F.pow(F.sum("tokens").cast("double"), F.lit(float(target))).alias("power"))
    whole_power = there.agg(F.sum("power")).first()[0] or 1.0
    return there.select(dim, (F.col("power") / F.lit(float(whole_power))).alias("share"))


def rake(cells: DataFrame, targets: Mapping[str, Mapping[str, float] | float], rounds: int) -> DataFrame:
    """Cells with a weight whose sums over each dimension's values follow the targets; weights sum to the tokens."""
    total = cells.agg(F.sum("tokens").alias("n")).first()["n"]
    if not total:
        return cells.withColumn("weight", F.lit(0.0))
    shares = {dim: cut_lineage(_targets(cells, dim, target)) for dim, target in targets.items()}
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for step in range(rounds):
        if step % 3 == 0:
            tidy(cells.sparkSession)
        for dim, share in shares.items():
            now = out.groupBy(dim).agg(F.sum("weight").alias("now"))
            scale = now.join(share, dim, "left").select(dim, F.when(F.col("now") > 0, F.coalesce("share", F.lit(0.0)) * float(total) / F.col("now")).otherwise(0.0).alias("scale"))
            out = out.join(scale, dim).withColumn("weight", F.col("weight") * F.col("scale")).drop("scale")
        out = cut_lineage(out)
    return out


def calibrate(cells: DataFrame, budget: float) -> DataFrame:
    """Cells with the probability of their documents: the weight over the tokens, times one factor, at most 1."""
    wanted = cells.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    wanted = budget * wanted
    factor = 0.0
    while True:  # cells that reach 1 stay there while the factor grows, so this ends
        full = (F.col("weight") * F.lit(factor) >= F.col("tokens")) & (F.col("weight") > 0)
        sums = cells.agg(F.sum(F.when(full, F.col("tokens"))).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if not sums["open"]:
            factor = float("inf") if factor else 0.0
            break
        new = (wanted - (sums["full"] or 0)) / sums["open"]
        if new <= factor:
            break
        factor = new
    if factor == float("inf"):
        chance = F.when(F.col("weight") > 0, 1.0).otherwise(0.0)
    else:
        chance = F.least(F.lit(1.0), F.lit(factor) * F.col("weight") / F.col("tokens"))
    return cells.withColumn("probability", F.when(F.col("tokens") > 0, chance).otherwise(1.0))


def _cell(docs: DataFrame, topic: Column | None, text_col: str, source_col: str, lang_col: str) -> dict[str, Column]:
    """The columns of a document that decide its probability."""
    value = lambda c: F.coalesce(c.cast("string"), F.lit(NONE))
    return {
        "source": value(F.col(source_col)),
        "lang": value(F.col(lang_col)),
        "topic": value(topic if topic is not None else form_of(text_col)),
        "n_tokens": tokens(text_col),
    }


def _chances(rows: DataFrame, targets: Mapping[str, Mapping[str, float] | float], rounds: int, budget: float) -> DataFrame:
    """(source, lang, topic, probability) of all cells."""
    cells = cut_lineage(rows.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("tokens")))
    return cut_lineage(calibrate(rake(cells, targets, rounds), budget)).select("source", "lang", "topic", "probability")


def mix(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float] | float],
    topic: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    rounds: int = 12,
    budget: float = 0.5,
    seed: str = "mix",
) -> DataFrame:
    """id, source, lang, topic, n_tokens, probability and kept of every document.

    ``targets`` names ``source``, ``lang`` and ``topic``; ``topic`` is a column of the documents.
    """
    cell = _cell(docs, topic, text_col, source_col, lang_col)
    rows = cut_lineage(docs.select(F.col(id_col).alias("id"), *[c.alias(k) for k, c in cell.items()]))  # the texts are read once
    out = rows.join(_chances(rows, targets, rounds, budget), ["source", "lang", "topic"])
    drawn = (F.col("n_tokens") == 0) | (draw("id", seed) < F.col("probability"))
    chance = F.when(F.col("n_tokens") == 0, 1.0).otherwise(F.col("probability"))
    return out.select(F.col("id").alias(id_col), "source", "lang", "topic", "n_tokens", chance.alias("probability"), drawn.alias("kept"))


def sample(
    docs: DataFrame,
    targets: Mapping[str, Mapping[str, float] | float],
    topic: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    lang_col: str = "lang",
    rounds: int = 12,
    budget: float = 0.5,
    seed: str = "mix",
) -> DataFrame:
    """The documents drawn, all their columns; they are those that ``mix`` marks kept."""
    cell = _cell(docs, topic, text_col, source_col, lang_col)
    rows = cut_lineage(docs.select(*[c.alias(k) for k, c in cell.items()]).groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("n_tokens")))
    chances = _chances(rows, targets, rounds, budget)
    # the row travels as one column: no name of its own can clash
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("id"), *[c.alias(k) for k, c in cell.items()])
    drawn = (F.col("n_tokens") == 0) | (draw("id", seed) < F.col("probability"))
    return keyed.join(chances, ["source", "lang", "topic"]).where(drawn).select("row.*")
