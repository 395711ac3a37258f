"""Recommendations and advertisements, both with a seeded choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordermill.operators.dedupe import first_by

RECOMMENDED, SHOWN = 5, 4
FALLBACK_ADS = 2
SALTS = 64
SLOT_DIGITS = 2
# Rounds of the permutation, an even number, and the field its keys are squared in.
ROUNDS, PRIME = 4, 2**31 - 1


def draw(*parts: Column) -> Column:
    """A repeatable random order: the digest of the parts."""
    return F.md5(F.concat_ws("|", *(p.cast("string") for p in parts)).cast("binary"))


def recommend(requests: DataFrame, baskets: DataFrame, catalogue: DataFrame, seed: int = 0, k: int = RECOMMENDED) -> DataFrame:
    """Up to ``k`` random products of the catalogue that are not in the basket.

    ``requests``: request_id; ``baskets``: request_id, product_id (one row per product);
    ``catalogue``: product_id. The catalogue is numbered, and each request has a
    permutation of the numbers of its own, of which it takes as many as its basket may
    strike out and ``k`` more: a sample without replacement by an equi-join on
    numbers, whatever the catalogue's size.
    """
    numbered, size = _numbered(catalogue, ["product_id"])
    held = baskets.groupBy("request_id").agg(F.count(F.lit(1)).alias("held"))
    wanted = F.least(F.col("rows"), F.coalesce("held", F.lit(0)) + k)
    digest = draw(F.col("request_id"), F.lit(seed))
    keys = F.array(*(F.conv(F.substring(digest, 1 + 7 * i, 7), 16, 10).cast("bigint") for i in range(ROUNDS)))
    drawn = (
        requests.join(held, "request_id", "left")
        .join(F.broadcast(size), F.lit(True))  # one row
        .where("rows > 0")
        .withColumn("_keys", keys)
        .withColumn("step", F.explode(F.sequence(F.lit(0).cast("bigint"), wanted - 1)))
        .withColumn("number", permuted(F.col("step"), F.col("rows"), F.col("_keys")))
    )
    found = drawn.join(numbered, "number").select("request_id", "step", "product_id")
    free = found.join(baskets.select("request_id", "product_id"), ["request_id", "product_id"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("request_id").orderBy("step"))
    return free.withColumn("rank", rank).where(F.col("rank") <= k).select("request_id", "rank", "product_id", (F.col("rank") <= SHOWN).alias("shown"))


def permuted(step: Column, rows: Column, keys: Column) -> Column:
    """Where a keyed permutation of 0 .. rows - 1 puts ``step``.

    Feistel rounds over a grid of a x b places, the smallest near-square one that holds all rows; fewer than
    a places are too many. A step that lands on one of those goes on from there, which
    ends after as many turns as there are such places and is rare: about one step in sqrt(rows).
    """
    a = F.ceil(F.sqrt(rows.cast("double"))).cast("bigint")
    b = F.ceil(rows / a).cast("bigint")

    def mixed(value: Column, key: int) -> Column:
        moved = (value + keys[key]) % PRIME
        return moved * moved % PRIME

    def turn(place: Column) -> Column:
        left, right = F.floor(place / b), place % b
        for key in range(0, ROUNDS, 2):
            left = (left + mixed(right, key)) % a
            right = (right + mixed(left, key + 1)) % b
        return left * b + right

    spare = F.sequence(F.lit(1).cast("bigint"), F.greatest(a * b - rows, F.lit(1).cast("bigint")))
    first = turn(step)
    return F.when(first < rows, first).otherwise(F.aggregate(spare, first, lambda at, _: F.when(at < rows, at).otherwise(turn(at))))


def ads_for(requests: DataFrame, ads: DataFrame, seed: int = 0) -> DataFrame:
    """Ads of a request's context keys, in key order and with repeats; two random
    ads where no key has any.

    ``requests``: request_id, context_keys; ``ads``: category, redirect_url, text.
    Most requests may ask for one category, so requests are salted and the few ads
    of a category are there once per salt. Requests without keys go straight to the
    random ads; of the others each row knows whether its key has ads, so that they
    are joined once.
    """
    asks = F.coalesce(F.size("context_keys"), F.lit(0)) > 0
    keyed = requests.where(asks).select("request_id", F.posexplode("context_keys").alias("key_pos", "category"))
    salted = keyed.withColumn("_salt", F.pmod(F.xxhash64("request_id"), F.lit(SALTS)).cast("int"))
    copies = ads.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = salted.join(copies, ["category", "_salt"], "left")
    any_hit = F.count("redirect_url").over(Window.partitionBy("request_id"))
    known = met.withColumn("_hits", any_hit)
    matched = known.where("redirect_url is not null").select(
        "request_id", "key_pos", "redirect_url", "text", F.lit(False).alias("fallback")
    )
    missed = known.where("_hits = 0 and key_pos = 0").select("request_id")
    unmatched = requests.where(~asks).select("request_id").unionByName(missed)
    return matched.unionByName(random_ads(unmatched, ads, seed))


def random_ads(requests: DataFrame, ads: DataFrame, seed: int = 0, n: int = FALLBACK_ADS) -> DataFrame:
    """``n`` random ads per request, repeats possible.

    Each draw is an index into the numbered ads: an equi-join, no pairs. The ads
    are numbered per hash slot and the slots by their running size, so no task
    sees all of them.
    """
    numbered, size = _numbered(ads, ["category", "redirect_url", "text"])
    index = F.pmod(
        F.conv(F.substring(draw(F.col("request_id"), F.col("key_pos"), F.lit(seed)), 1, 12), 16, 10).cast("bigint"),
        F.col("rows"),
    )
    drawn = (
        requests.select("request_id", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("key_pos"))
        .join(F.broadcast(size), F.lit(True))
        .withColumn("number", index)
    )
    return drawn.join(numbered, "number").select(
        "request_id", "key_pos", "redirect_url", "text", F.lit(True).alias("fallback")
    )


def _numbered(ads: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with a dense ``number`` from 0, one row with how many there are)."""
    slotted = ads.withColumn("slot", F.substring(draw(*(F.col(c) for c in order)), 1, SLOT_DIGITS))
    sizes = slotted.groupBy("slot").agg(F.count(F.lit(1)).alias("n"))  # at most 16 ** SLOT_DIGITS rows
    before = F.coalesce(
        F.sum("n").over(Window.orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    starts = sizes.select("slot", before.alias("start"))
    number = F.col("start") + F.row_number().over(Window.partitionBy("slot").orderBy(*order)) - 1
    numbered = slotted.join(F.broadcast(starts), "slot").withColumn("number", number).drop("slot", "start")
    return numbered, ads.agg(F.count(F.lit(1)).alias("rows"))


def choose_ad(candidates: DataFrame, seed: int = 0) -> DataFrame:
    """One random ad out of each request's candidates."""
    pick = draw(F.col("request_id"), F.col("key_pos"), F.col("redirect_url"), F.lit(seed))
    return first_by(
        candidates.withColumn("_draw", pick), ["request_id"], ["_draw", "redirect_url"]
    ).drop("_draw")
