"""Order MinHash fingerprints: sensitive to edits and to the order of what stays.

A text's words form k-mers of `K` neighbouring words; each k-mer is numbered by its occurrence in the text, so repeated
ones are distinct. A hash deals the numbered k-mers to `CELLS` cells, and each cell selects its minimal one. A signature
takes the minimal k-mers of two neighbouring cells (the last cell's neighbour is the first), puts them in the order in
which they stand in the text and hashes the tuple: texts agree on a signature if they agree on the selected k-mers and on
their order. The likeness of two fingerprints is the share of equal signatures among those that either has.

Everything is DataFrame functions. Texts are dealt once, by place in the order of ids; the k-mers of a text are spread,
numbered and reduced in the task that has the text, so they are never shuffled. Fewer than `K` words form one k-mer; a text
without words has the empty fingerprint, and two empty ones are alike (1). Missing texts are empty. Repeated ids are
ordered by their texts, and each row has its own result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import keyed_text, written

K = 2
CELLS = 32                 # also the number of signatures
PLACE_BITS = 24            # the low bits of a packed k-mer hold its place in the text
MOST_PARTS = 20_000
TASKS = 4                  # times the shuffle partitions: a text's k-mers take several times its own memory


def tasks(df: DataFrame) -> int:
    return TASKS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_order(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Adds `part`: a range of ids, so that the rows of a part are a bounded window. The ranges follow approximate
    quantiles of the ids, two for each task; rows find theirs by binary search."""
    parts = max(2, min(MOST_PARTS, 2 * tasks(df)))
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = df.agg(F.percentile_approx(id_col, shares, 10 * parts)).scalar()

    def halve(state: Column, _: Column) -> Column:
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        above = F.coalesce(F.get(state["cuts"], middle) < F.col(id_col), F.lit(False)) & (state["low"] < state["high"])
        return F.struct(F.when(above, middle + 1).otherwise(state["low"]).alias("low"),
                        F.when(above, state["high"]).otherwise(F.least(middle, state["high"])).alias("high"), state["cuts"].alias("cuts"))

    begin = F.struct(F.lit(0).alias("low"), F.coalesce(F.size("cuts"), F.lit(0)).alias("high"), F.col("cuts"))
    steps = F.sequence(F.lit(1), F.lit(parts.bit_length()))
    return df.withColumn("cuts", cuts).withColumn("part", F.coalesce(F.aggregate(steps, begin, halve, lambda s: s["low"]), F.lit(0))).drop("cuts")


def with_next(df: DataFrame, column: str = "text") -> DataFrame:
    """Adds `row`, the place in the part by (id, `column`), and `next`, the column's value in the following row of all; the
    last row is followed by the first. A part's last row takes the first row of the next part that has rows. Those edges,
    a row a part, are found by the least ids of the parts, so that the texts are dealt only once."""
    least = F.broadcast(df.groupBy("part").agg(F.min("id").alias("least")).withColumnRenamed("part", "of"))  # at most MOST_PARTS rows
    first = df.join(least, (F.col("part") == F.col("of")) & F.col("id").eqNullSafe(F.col("least")))
    first = first.groupBy("part").agg(F.min(column).alias("edge"))
    over_parts = Window.orderBy("part")
    edges = first.select("part", F.coalesce(F.lead(F.struct("edge")).over(over_parts), F.first(F.struct("edge")).over(
        over_parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    inside = Window.partitionBy("part").orderBy("id", column)
    # so many tasks that the k-mers of each are sorted in memory
    rows = df.repartition(tasks(df), "part").withColumns({"row": F.row_number().over(inside), "follow": F.lead(F.struct(F.col(column).alias("edge"))).over(inside)})
    return rows.join(edges, "part", "left").withColumn("next", F.coalesce("follow", "after")["edge"]).drop("follow", "after")


def fingerprints(df: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """Each row's `fingerprint`: `CELLS` hashes in hexadecimal, comma-joined, empty where no k-mer is. `keys` identify rows;
    a table that is dealt by some of them is not dealt again."""
    words = F.filter(F.split(F.col(text_col), r"\s+"), lambda w: w != "")
    mers = df.select(*keys, words.alias("words"))
    count = F.greatest(F.size("words") - (K - 1), F.least(F.size("words"), F.lit(1)))
    spread = mers.select(*keys, "words", F.explode_outer(F.when(count > 0, F.sequence(F.lit(0), count - 1))).alias("place"))
    mer = F.xxhash64(*[F.get("words", F.col("place") + i) for i in range(K)])
    spread = spread.select(*keys, "place", F.xxhash64(*keys, mer).alias("same"), mer.alias("mer"))
    # the hash comes first, as sorting by one number is fast; the keys keep the rows where they are
    number = F.row_number().over(Window.partitionBy("same", *keys).orderBy("place"))
    numbered = spread.withColumn("hash", F.xxhash64("mer", number))
    # a place beyond the mask counts as the last; the sign bit is cleared; above the place stand bits that did not choose the cell
    mask = (1 << PLACE_BITS) - 1
    high = F.shiftright(F.shiftrightunsigned("hash", 1), PLACE_BITS - 1)
    packed = F.shiftleft(high, PLACE_BITS).bitwiseOR(F.least(F.col("place"), F.lit(mask)).cast("long"))
    numbered = numbered.select(*keys, F.pmod(F.col("hash"), F.lit(CELLS)).alias("cell"), F.when(F.col("place").isNotNull(), packed).alias("packed"))
    least = numbered.groupBy(*keys).agg(*[F.min(F.when(F.col("cell") == i, F.col("packed"))).alias(f"m{i}") for i in range(CELLS)])

    def signature(i: int) -> Column:
        a, b = F.col(f"m{i}"), F.col(f"m{(i + 1) % CELLS}")
        x, y = F.shiftright(a, PLACE_BITS), F.shiftright(b, PLACE_BITS)
        # one hash of the pair in text order; a missing one is null in the hash
        first = b.isNull() | (a.bitwiseAND(mask) <= b.bitwiseAND(mask))
        code = F.xxhash64(F.when(first, x).otherwise(y), F.when(first, y).otherwise(x))
        return F.when(a.isNull() & b.isNull(), F.lit("")).otherwise(F.substring(F.lpad(F.hex(code), 16, "0"), 1, 8))

    return least.select(*keys, F.array_join(F.array(*[signature(i) for i in range(CELLS)]), ",").alias("fingerprint"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures among those that either fingerprint has; 1 for two empty ones."""
    pairs = F.arrays_zip(F.split(a, ",").alias("a"), F.split(b, ",").alias("b"))
    filled = F.filter(pairs, lambda p: (p["a"] != "") | (p["b"] != ""))
    same = F.size(F.filter(filled, lambda p: p["a"] == p["b"]))
    return F.when(a == b, F.lit(1.0)).otherwise(F.coalesce(F.try_divide(same, F.size(filled)), F.lit(0.0))).cast("double")


def compare_neighbours(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each text its number of code points, the digest of its edited form (the last half of its code points replaced
    by the beginning of the next text), both fingerprints, and the next text's one as `next_fingerprint`."""
    rows = with_next(in_order(keyed_text(df, id_col, text_col)))
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.left("text", F.length("text") - half), F.left("next", half)))
    version = F.explode(F.array(F.struct(F.lit(0).alias("is_edited"), F.col("text")), F.struct(F.lit(1).alias("is_edited"), F.col("edited").alias("text"))))
    found = fingerprints(rows.select("part", "row", version.alias("v")).select("part", "row", "v.is_edited", "v.text"), ["part", "row", "is_edited"])
    # a text, its edited form and the next text stand below each other
    lined_up = Window.partitionBy("part").orderBy("row", "is_edited")
    found = found.withColumns({"edited_fingerprint": F.lead("fingerprint", 1).over(lined_up), "next_fingerprint": F.lead("fingerprint", 2).over(lined_up)})
    facts = rows.select("part", "row", "id", F.length("text").cast("long").alias("n_chars"), F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"))
    done = written(facts.join(found.filter("is_edited = 0").drop("is_edited"), ["part", "row"]), "fingerprints")
    over_parts = Window.orderBy("part")
    edges = done.filter("row = 1").select("part", "fingerprint")
    edges = edges.select("part", F.coalesce(F.lead("fingerprint").over(over_parts), F.first("fingerprint").over(
        over_parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    # an edge is one fingerprint, and there are at most MOST_PARTS of them: some megabytes, so that nothing more is shuffled
    return done.join(F.broadcast(edges), "part", "left").select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                                                   F.coalesce("next_fingerprint", "after").alias("next_fingerprint"))
