"""Mix sources to target weights by Pfair scheduling.

Weights become whole numbers ``m`` out of ``M``: weights of up to ``PLACES`` decimals by a power of ten, others rounded
with ``M`` near 2 ** 61 over the length of the mix, so products stay in 64 bits.  The i-th document of a source is released at slot floor((i - 1) * M / m) and due at slot ceil(i * M / m).  In each slot the
released document with the earliest deadline goes, ties by source.  Every deadline is met, so in every prefix of the mix
a source is less than one document away from its weight.

Slots are scheduled in segments, each by itself.  Where a segment ends, some documents are released and not yet due; as
many of them go before the end as slots are left.  They are chosen by deadline, but of those released last never more
than their shares up to there, rounded up: by two-way rounding such a choice leaves both sides their slots.  A segment is
so long that a document is open across one end at most, so the ends don't depend on each other.

That length grows as the lightest source gets lighter.  Sources below 1 / ``LIGHT`` of the mix are therefore dealt as one
source, whose slots are spread evenly, and are scheduled among themselves in the same way.  Only where there are such
sources may a source be up to two documents away from its weight.

The mix ends where every source has been used once in full; sources that run out earlier begin again (epoch 1, 2, ...).
So no document is lost, and the rows of the mix have the target weights.

Within a source the order is that of a hash of the id.  Defined results: rows without source form one source; rows
without id, null texts and repeated rows are mixed like others; a source whose weight is not given, or not above zero,
is spread once over the mix of the others; an empty table gives an empty mix.  Other columns are carried along; columns
already called epoch or slot are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillsight.session import stage, tune

BUCKETS = 256
LIGHT = 1 << 15
RUN = 256  # slots whose order is kept in one array while a segment is scheduled
SPAN = 1024  # least slots of a segment
PLACES = 6
AHEAD = 64  # segments that are dealt out together


def tempered(counts: DataFrame, power: float = 0.9) -> DataFrame:
    """Default weights: rows of a source to a power below 1, which lifts small sources a little."""
    return counts.select("source", F.pow("n", F.lit(power)).alias("weight"))


def _div(a: Column, b: Column | int) -> Column:
    """Whole-number division of 64-bit numbers from 0 on."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _release(done: Column, m: Column, of: int) -> Column:
    """First slot of the document after ``done`` others of a source with ``m`` of ``of`` slots."""
    return _div(done * of, m)


def _due(done: Column, m: Column, of: int) -> Column:
    """First slot by which that document must have gone."""
    return _div((done + 1) * of + m - 1, m)


def done_before(sources: Column, slot: Column, of: int) -> Column:
    """How many documents of each source (struct with ``m``) go before ``slot``: its share, rounded down or up."""
    def released(x: Column, i: Column) -> Column:
        done = _div(slot * x["m"], of)
        return F.struct(_due(done, x["m"], of).alias("due"), i.alias("i"), _release(done, x["m"], of).alias("r"),
                        F.pmod(slot * x["m"], F.lit(of)).alias("part"))

    def room(open_: Column) -> Column:
        # Of the documents released at r or later, no more than their shares, rounded up.
        return F.transform(open_, lambda x: F.struct(x["r"].alias("r"), _div(F.aggregate(
            F.filter(open_, lambda y: y["r"] >= x["r"]), F.lit(of - 1).cast("long"), lambda s, y: s + y["part"]), of).alias("left")))

    def take(state: Column, x: Column) -> Column:
        free = ~F.exists(state["room"], lambda y: (y["r"] <= x["r"]) & (y["left"] < 1))
        return F.when(free, F.struct(
            F.transform(state["room"], lambda y: F.struct(
                y["r"].alias("r"), (y["left"] - (y["r"] <= x["r"]).cast("long")).alias("left"))).alias("room"),
            F.concat(state["chosen"], F.array(x["i"])).alias("chosen"))).otherwise(state)

    def counted(open_: Column) -> Column:
        start = F.struct(room(open_).alias("room"), F.array().cast("array<int>").alias("chosen"))
        return _let(F.aggregate(F.array_sort(open_), start, take)["chosen"], lambda chosen: F.transform(
            sources, lambda x, i: _div(slot * x["m"], of) + F.array_contains(chosen, i).cast("long")))

    return _let(F.filter(F.transform(sources, released), lambda x: x["part"] > 0), counted)


def _segment(sources: Column, first: Column, span: int, of: int) -> Column:
    """(g, e) for each of ``span`` slots from ``first`` on: the source that goes and how many of its documents went before."""
    def planned(ends: Column) -> Column:
        def pick(state: Column, slot: Column) -> Column:
            def candidate(x: Column, i: Column) -> Column:
                done = F.get(state["done"], i)
                ready = (done < F.get(ends["after"], i)) & (_release(done, x["m"], of) <= slot)
                return F.when(ready, F.struct(_due(done, x["m"], of).alias("due"), i.alias("i")))

            return _let(F.array_min(F.transform(sources, candidate))["i"], lambda best: F.struct(
                F.transform(state["done"], lambda d, i: F.when(i == best, d + 1).otherwise(d)).alias("done"),
                F.concat(state["order"], F.array(F.struct(
                    F.get(sources, best)["g"].alias("g"), F.get(state["done"], best).alias("e")))).alias("order")))

        def run(state: Column, start: Column) -> Column:
            empty = F.struct(state["done"].alias("done"), F.array().cast(order).alias("order"))
            return _let(F.aggregate(F.sequence(start, start + RUN - 1), empty, pick), lambda more: F.struct(
                more["done"].alias("done"), F.concat(state["order"], more["order"]).alias("order")))

        order = "array<struct<g:string,e:bigint>>"
        starts = F.sequence(first, first + span - RUN, F.lit(RUN).cast("long"))
        begin = F.struct(ends["before"].alias("done"), F.array().cast(order).alias("order"))
        return F.aggregate(starts, begin, run)["order"]

    return _let(F.struct(done_before(sources, first, of).alias("before"),
                         done_before(sources, first + span, of).alias("after")), planned)


def schedule(shares: DataFrame, slots: int) -> DataFrame:
    """(g, e, slot): the source of each slot and how many of its documents went before, for shares (g, m) of the sum of m.

    The sum times ``slots`` and a segment must stay below 2 ** 62.
    """
    of, least = shares.agg(F.sum("m"), F.min("m")).first()
    span = max(SPAN, 1 << (of // least + 2).bit_length())
    segments = -(-slots // span)
    one = shares.agg(F.sort_array(F.collect_list(F.struct("g", "m"))).alias("s"))  # the sources: one row
    blocks = one.select("s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit((segments - 1) // AHEAD).cast("long"))).alias("block"))
    parts = max(1, min(segments, int(shares.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    each = blocks.select("s", F.explode(F.sequence(F.col("block") * AHEAD, F.least(
        F.col("block") * AHEAD + AHEAD, F.lit(segments)) - 1)).alias("k")).repartition(parts, "k")
    first = (F.col("k") * span).cast("long")
    rows = each.select(first.alias("first"), F.posexplode(_segment(F.col("s"), first, span, of)).alias("at", "x"))
    return rows.select("x.g", "x.e", (F.col("first") + F.col("at")).alias("slot")).filter(F.col("slot") < slots)


def _nth(n: Column, upto, guess: Column) -> Column:
    """The first x for which ``upto`` (x + 1) is above n; the guess is close."""
    near = F.sequence(F.greatest(F.floor(guess) - 3, F.lit(0).cast("long")), F.floor(guess) + 3)
    return F.array_min(F.filter(near, lambda x: upto(x + 1) > n))


def _weighted(counts: DataFrame, weights: DataFrame | None) -> DataFrame:
    """(g, n, w): rows and weight, above zero, of each source."""
    weights = tempered(counts) if weights is None else weights
    given = weights.groupBy(F.col("source").alias("named")).agg(F.max("weight").cast("double").alias("weight"))
    found = counts.join(given, F.col("source").eqNullSafe(F.col("named")), "left").withColumn(
        "w", F.when((F.col("weight") > 0) & (F.col("weight") < float("inf")), F.col("weight"))).select("g", "n", "w")
    found = stage(found, "weights")
    horizon = found.agg(F.max(F.col("n") / F.col("w"))).first()[0] or 1.0
    return stage(found.select("g", "n", F.coalesce("w", F.col("n") / horizon).alias("w")), "weights")


def _planned(sources: DataFrame) -> tuple[DataFrame, int, float]:
    """The schedule (g, e, slot), how many slots it has, and the slots for one unit of weight."""
    scales = [10 ** k for k in range(PLACES + 1)]
    off = [F.max(F.abs(F.col("w") * x - F.round(F.col("w") * x)) / (F.col("w") * x)) for x in scales]
    count, total, horizon, *off = sources.agg(F.count("*"), F.sum("w"), F.max(F.col("n") / F.col("w")), *off).first()
    precision = (1 << 61) // (int(horizon * total) + 4 * max(LIGHT, 2 * count))  # the mix and one segment
    # Whole weights and short decimals are taken as they are.
    exact = next((x for x, d in zip(scales, off) if d < 1e-12 and total * x < precision), None)
    # Tiers: the sources of one are not too unlike in weight; the first has the heaviest.
    tiers, left = [], sources
    while True:
        mass, n = left.agg(F.sum("w"), F.count("*")).first()
        if not n:
            break
        cut = mass / max(LIGHT, 2 * n)
        whole = F.col("w") * exact if exact else F.greatest(F.lit(1), F.col("w") / mass * precision)
        part = F.round(whole).cast("long").alias("m")
        tiers.append((mass, stage(left.filter(F.col("w") >= cut).select("g", "n", part), "tier")))
        left = left.filter(F.col("w") < cut)
    if len(tiers) == 1:
        shares = tiers[0][1]
        of = shares.agg(F.sum("m")).first()[0]
        slots = shares.agg(F.max(_div(F.col("n") * of + F.col("m") - 1, F.col("m")))).first()[0]
    else:  # a source may be two documents late, and more by rounding of weights in very long mixes
        late = 3 + int(horizon * total) // precision
        slots = int(sources.agg(F.max((F.col("n") + late) / F.col("w"))).first()[0] * total) + 1
    plan, length, above = None, slots, []
    for (mass, shares), rest in zip(tiers, [m for m, _ in tiers[1:]] + [0.0]):
        light = rest / mass

        def upto(x: Column, light=light) -> Column:
            return F.floor(x * light + 0.5)

        lower = int(length * light + 0.5)
        own = schedule(shares, length - lower) if length > lower else None
        if own is not None:
            place = F.col("slot")
            if rest:
                place = _nth(place, lambda x, upto=upto: x - upto(x), (place + 0.5) / (1 - light))
            own = own.withColumn("slot", place)
            for share, count in reversed(above):
                own = own.withColumn("slot", _nth(F.col("slot"), count, (F.col("slot") + 0.5) / share))
            plan = own if plan is None else plan.unionByName(own)
        above.append((light, upto))
        length = lower
    return plan, slots, slots / total


def _placed(docs: DataFrame, weights: DataFrame | None, id_col: str, source_col: str) -> DataFrame:
    """(row, epoch, slot) with the columns of ``docs`` packed in ``row``."""
    tune(docs.sparkSession)
    named = docs[source_col].cast("string")
    # ``g`` is the source, never null.
    rows = docs.select(F.struct("*").alias("row"), F.xxhash64(docs[id_col].cast("string")).alias("h"),
                       F.when(named.isNull(), "null").otherwise(F.concat(F.lit("="), named)).alias("g"))
    # A source of any size is numbered in many buckets: rows of a bucket by a window, the buckets by their counts.
    size = docs.count()
    buckets = max(BUCKETS, size // 50_000)
    rows = rows.withColumn("bucket", F.floor((F.col("h") / float(1 << 64) + 0.5) * F.lit(buckets)).cast("int"))
    if not size:
        return rows.select("row", F.lit(0).alias("epoch"), F.lit(0).cast("long").alias("slot"))
    filled = stage(rows.groupBy("g", "bucket").agg(F.count("*").alias("c")), "buckets")
    before = Window.partitionBy("g").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    source = F.when(F.col("g") != "null", F.expr("substring(g, 2)")).alias("source")
    counts = filled.groupBy("g").agg(F.sum("c").alias("n")).select("g", source, "n")
    sources = _weighted(counts, weights)
    plan, _, rate = _planned(sources)
    skips = filled.select("g", "bucket", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("skip"))
    # Rows of the mix at most; those beyond its end meet no slot.
    most = F.floor(F.col("w") * rate * (1 + 1e-9)) + 8
    skips = skips.join(sources.select("g", "n", most.alias("most")), "g")
    inside = Window.partitionBy("g", "bucket").orderBy("h")
    numbered = rows.withColumn("k", F.row_number().over(inside) - 1).join(skips, ["g", "bucket"])
    numbered = numbered.withColumn("k", F.col("k") + F.col("skip"))
    last = F.greatest(F.floor((F.col("most") - F.col("k")) / F.col("n")), F.lit(0).cast("long"))
    epochs = numbered.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    epochs = epochs.select("row", F.col("epoch").cast("int").alias("epoch"), "g", (F.col("k") + F.col("epoch") * F.col("n")).alias("e"))
    # The plan has a row for each slot, but Spark sees one row exploded and would take it for small.
    return epochs.join(plan.hint("merge"), ["g", "e"]).select("row", "epoch", "slot")


def mix(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with epoch and slot: reading by slot gives the mix.  ``weights`` has columns source and weight."""
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("epoch", "slot")]
    return _placed(docs, weights, id_col, source_col).select(*kept, "epoch", "slot")


def mixed_rows(docs: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id",
               source_col: str = "source") -> DataFrame:
    """The rows of the mix with the columns of ``docs`` alone."""
    placed = _placed(docs, weights, id_col, source_col)
    return placed.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
