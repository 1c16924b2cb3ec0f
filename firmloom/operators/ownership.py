"""Ultimate owners: from every company up the ownership graph to those that nobody owns.

Stages first: a company with one owner has what its owner has. So such companies are led, by pointer
doubling among themselves, to the next owner that is on top or has several owners (`_led`), and are
set aside; pointers of the others skip them, and those that then meet make a company of one owner for the
next stage. Where a stage leaves few companies, or hardly fewer than before, the rest is
walked by pointer doubling with all owners (`_walked`): pointers one step up, then two, four, eight.
Then what was set aside gets the owners of where it was led, last stage first.

So the rounds are some logarithms of the longest chain and of the companies. What never ends runs in a
circle, and is told by the number of companies with open ends: it falls in every round but the last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from firmloom.operators.checks import nonblank_endpoints
from firmloom.operators.shared import shared
from firmloom.operators.skew import salted_join

# Another stage follows while the last one left at most one in FEWER of the pointers before it, and the
# pointers left are more than one in FEW of the first ones.
FEWER, FEW = 1.5, 30


def _pointers(edges: DataFrame) -> DataFrame:
    """(lei, via, circular): each company's owners, blank ends and ownership of oneself left out."""
    return nonblank_endpoints(edges).where("firm_i <> firm_j").select(
        F.col("firm_i").alias("lei"), F.col("firm_j").alias("via"), F.lit(False).alias("circular")
    )


def _marked(pointers: DataFrame) -> DataFrame:
    """Different pointers, each with whether its company has one owner (or none, but circles)."""
    different = pointers.repartition("lei").groupBy("lei", "via").agg(F.max("circular").alias("circular"))
    company = Window.partitionBy("lei")
    several, none = F.count("via").over(company) > 1, F.count("via").over(company) == 0
    return (
        different.withColumns({"one": ~several, "_none": none, "_circular": F.max("circular").over(company)})
        .where("not one or via is not null or _none")
        .select("lei", "via", F.when(F.col("one"), F.col("_circular")).otherwise(F.col("circular")).alias("circular"), "one")
    )


def _skipped(pointers: DataFrame, onward: DataFrame) -> DataFrame:
    """Pointers moved on where `onward` (lei, via, circular; a company once) has their end; `moved` tells which.

    What comes back to its company runs in a circle, and so ends nowhere: its `via` is null.
    """
    steps = onward.select(F.col("lei").alias("via"), F.col("via").alias("_next"), F.col("circular").alias("_circular"))
    moved = F.col("_circular").isNotNull()
    via = F.when(moved, F.col("_next")).otherwise(F.col("via"))
    joined = salted_join(pointers.select("lei", "via", "circular"), steps, ["via"], ["lei"], "left")
    return joined.select(
        "lei",
        F.when(via != F.col("lei"), via).alias("via"),
        (F.col("circular") | F.coalesce("_circular", F.lit(False)) | F.coalesce(via == F.col("lei"), F.lit(False))).alias("circular"),
        moved.alias("moved"),
    )


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, parts)


def _led(ones: DataFrame, scratch: str) -> DataFrame:
    """Companies of one owner with the first owner that is not among them; null where they run in a circle."""
    found: list[DataFrame] = []
    going, left, number = ones, None, 0
    onward = F.col("moved") & F.col("via").isNotNull()
    while True:
        number += 1
        seen = Observation()
        moved = _skipped(going, _union([*found, going])).observe(seen, F.count_if(onward).alias("onward"))
        written = shared(moved, scratch, f"led-{number}")
        still = seen.get["onward"]
        # ends that did not move are found; the others go on, the next time twice as far
        found.append(written.where(~onward).drop("moved"))
        going = written.where(onward).drop("moved")
        if not still or still == left:
            break
        left = still
    if still:
        found.append(going.select("lei", F.lit(None).cast("string").alias("via"), F.lit(True).alias("circular")))
    return _union(found)


def _steps(pointers: DataFrame) -> DataFrame:
    """Pointers with `open`: whether their end has owners here."""
    owned = pointers.select(F.col("lei").alias("via")).distinct().withColumn("open", F.lit(True))
    nowhere = pointers.where("via is null").select("lei", "via", F.lit(False).alias("open"), "circular")
    return salted_join(pointers.where("via is not null"), owned, ["via"], ["lei"], "left").select(
        "lei", "via", F.coalesce("open", F.lit(False)).alias("open"), "circular"
    ).union(nowhere)


def _walked(pointers: DataFrame, scratch: str) -> DataFrame:
    """(lei, owner, circular) of the companies of `pointers`, by pointer doubling with all owners."""
    steps = shared(_steps(pointers), scratch, "steps-0")
    left, number = None, 0
    while True:
        live = steps.where("open")
        still = live.select("lei").distinct().count()
        if not still or still == left:
            break
        left, number = still, number + 1
        onward = steps.select(
            F.col("lei").alias("via"), F.col("via").alias("next"), F.col("open").alias("goes_on"),
            F.col("circular").alias("_circular"),
        )
        moved = salted_join(live.select("lei", "via", "circular"), onward, ["via"], ["lei"]).select(
            "lei", F.col("next").alias("via"), F.col("goes_on").alias("open"), (F.col("circular") | F.col("_circular")).alias("circular")
        )
        different = steps.where("not open").union(moved).groupBy("lei", "via", "open").agg(F.max("circular").alias("circular"))
        steps = shared(different, scratch, f"steps-{number}")
    # all open ends of a company in one row: counts, not lists
    top = F.col("via").isNotNull() & ~F.col("open")
    ends = steps.groupBy("lei").agg(F.max(F.col("open") | F.col("circular")).alias("circular"), (~F.max(top)).alias("nowhere"))
    found = steps.where(top).select("lei", F.col("via").alias("owner"))
    topped = salted_join(found, ends.select("lei", "circular"), ["lei"], ["owner"])
    nowhere = ends.where("nowhere").select("lei", F.lit(None).cast("string").alias("owner"), "circular")
    return topped.select("lei", "owner", "circular").union(nowhere)


def _owners_of_led(led: DataFrame, owners: DataFrame | None) -> DataFrame:
    """(lei, owner, circular) of led companies, from those of the companies they were led to."""
    if owners is None:
        return led.select("lei", F.col("via").alias("owner"), "circular")
    nowhere = led.where("via is null").select("lei", F.col("via").alias("owner"), "circular")
    above = owners.select(F.col("lei").alias("via"), "owner", F.col("circular").alias("_circular"))
    known: Column = F.col("_circular").isNotNull()
    return salted_join(led.where("via is not null"), above, ["via"], ["lei"], "left").select(
        "lei", F.when(known, F.col("owner")).otherwise(F.col("via")).alias("owner"),
        (F.col("circular") | F.coalesce("_circular", F.lit(False))).alias("circular"),
    ).union(nowhere)


def ultimate_owners(edges: DataFrame, scratch: str) -> DataFrame:
    """(lei, owner, circular): one row for every company of `edges` (firm_i owned by firm_j) that has an
    owner, and every company on top of it.

    A company may have several owners, and so several on top. `circular` tells that some chain of
    owners runs in a circle; where all do, `owner` is null. Rounds are written to `scratch`, a folder
    every executor can reach. Stages have at most the pointers of `edges`; a round of the rest has, for
    each company, its different owners some 2 ** k steps up, which large circles of companies with
    many owners each make many.
    """
    stages: list[DataFrame] = []
    pointers, first, before = _pointers(edges), None, None
    while True:
        folder = f"{scratch}/stage-{len(stages) + 1}"
        marked = shared(_marked(pointers), folder, "marked")
        several = marked.where("not one").select("lei", "via", "circular")
        total, left = marked.agg(F.count("*"), F.count_if(~F.col("one"))).first()
        if first is None:
            first = total
        elif left * FEWER > before or left * FEW < first:
            stages.append(_led(marked.where("one").select("lei", "via", "circular"), folder))
            break
        before = left
        stages.append(_led(marked.where("one").select("lei", "via", "circular"), folder))
        if not left:
            break
        pointers = _skipped(several, stages[-1]).select("lei", "via", "circular")
    owners = []
    if left:
        # the rest still points to what the last stage set aside
        rest = _skipped(several, stages[-1]).select("lei", "via", "circular")
        different = rest.groupBy("lei", "via").agg(F.max("circular").alias("circular"))
        owners.append(shared(_walked(shared(different, scratch, "rest"), scratch), scratch, "owners-rest"))
    for number, led in reversed(list(enumerate(stages, 1))):
        owners.append(shared(_owners_of_led(led, _union(owners) if owners else None), scratch, f"owners-{number}"))
    return _union(owners)
