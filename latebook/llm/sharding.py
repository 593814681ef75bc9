"""Sharding by histogram sort: splitters from exact byte counts, then one exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from latebook.llm.registry import query, table
from latebook.llm.text import cut

BITS = 64
#: How many key bits one round of probes resolves.
STEP = 10
#: Rows of a cell, in which slots are numbered independently, and bytes of the cells' starts up to
#: which they are sent to every task.
CELL_ROWS = 50_000
SMALL = 32 << 20
#: The keys of the order: equal texts side by side, an even spread by id within them, and, where
#: rows that agree in both are many, one of each row.
KEYS = ("_lb_text", "_lb_doc", "_lb_row")


def document_bytes(text: Column) -> Column:
    """UTF-8 bytes of the text and one separator."""
    return F.octet_length(F.coalesce(text, F.lit(""))).cast("long") + 1


def _leading(key: Column, bits: int) -> Column:
    """The leading bits of a key as a number; all 64 of them keep their own sign."""
    return F.shiftrightunsigned(key, BITS - bits) if bits < BITS else key


def _key(level: int) -> Column:
    return F.col(KEYS[level])


def splitters(keys: DataFrame, shards: int, tolerance: int) -> list[dict]:
    """For each inner shard border the path of (level, bits, prefix) cells that ends in its cell.

    Each round sums the exact bytes of the cells below the open ones, a table of at most
    ``2**STEP`` rows for each border, and walks on into the cell that a border falls into. A
    border is done when its cell holds at most ``tolerance`` bytes, or the keys are used up.
    The part of the cell that goes to the left is all or nothing, whichever is nearer.
    """
    total = keys.agg(F.sum("_lb_size")).first()[0] or 0
    goals = [total * i / shards for i in range(1, shards)]
    # an open border: (its goal, bytes before its cell, path); all start in the cell of all rows
    state = [{"goal": g, "before": 0, "path": [], "size": total, "open": total > 0} for g in goals]
    for level, _ in enumerate(k for k in KEYS if k in keys.columns):
        for used in range(0, BITS, STEP):
            bits = min(used + STEP, BITS)
            parents = {tuple(s["path"]) for s in state if s["open"]}
            if not parents:
                break
            inside = F.lit(False)
            for path in parents:
                inside = inside | _in_cell(path)
            # a cell is known by the finished keys before it and the leading bits of its own
            above = [_key(i) for i in range(level)]
            above += [_leading(_key(level), used)] if used else []
            cells: dict[tuple, list[tuple[int, int]]] = {}
            counted = (keys.filter(inside)
                       .groupBy(F.array(*above).cast("array<long>").alias("above"),
                                _leading(_key(level), bits).alias("c"))
                       .agg(F.sum("_lb_size").alias("n")))
            for row in counted.collect():  # at most 2**STEP rows for each border
                cells.setdefault(tuple(row["above"]), []).append((row["c"], row["n"]))
            for s in state:
                if not s["open"]:
                    continue
                before = s["before"]
                found = sorted(cells[tuple(x[2] for x in s["path"])], key=lambda x: x[0] % (1 << 64))
                for cell, size in found:
                    if before + size >= s["goal"] or (cell, size) == found[-1]:
                        break
                    before += size
                s["before"], s["size"] = before, size
                s["path"] = [x for x in s["path"] if x[0] != level] + [(level, bits, cell)]
                s["open"] = size > tolerance
    for s in state:
        s["left"] = s["goal"] - s["before"] > s["size"] / 2
    return state


def _in_cell(path: tuple | list) -> Column:
    found = F.lit(True)
    for level, bits, prefix in path:
        found = found & (_leading(_key(level), bits) == F.lit(prefix).cast("long"))
    return found


def _after(path: list, left: bool) -> Column:
    """Whether a row lies to the right of a border; keys are ordered as unsigned numbers."""
    later, equal = F.lit(False), F.lit(True)
    flip = F.lit(-(1 << 63)).cast("long")
    for level, bits, prefix in path:
        mine = _leading(_key(level), bits)
        other = F.lit(prefix).cast("long")
        greater = (mine.bitwiseXOR(flip) > other.bitwiseXOR(flip)) if bits == BITS else mine > other
        later, equal = later | (equal & greater), equal & (mine == other)
    return later if left else later | equal


def shard_documents(docs: DataFrame, shards: int = 8, tolerance: float = 1e-4) -> DataFrame:
    """Deal documents into shards of nearly equal bytes.

    The order is that of a hash of the text and then of one of the id, so that copies lie
    side by side and are cut only where a border falls among them. Rows that agree in both are
    dealt one by one if they are many. ``tolerance`` is the share of a shard by which a border may
    miss its place; one document may be larger than that.

    Returns every row with all its columns plus ``shard`` (0 to ``shards`` - 1) and ``slot``
    (gapless from 0 within the shard), replacing columns of these names. No rows give no rows;
    a null text has no bytes, a null id is an id, and repeated rows keep their own slots.
    Documents cross the network once, to the tasks that number them.
    """
    placed = place(docs, shards, tolerance)
    return placed.drop(*KEYS, "_lb_size", "_lb_cell")


def place(docs: DataFrame, shards: int, tolerance: float) -> DataFrame:
    text, ident = docs["text"], docs["doc_id"]
    keyed = docs.drop("shard", "slot").withColumns({
        "_lb_text": F.xxhash64(F.coalesce(text, F.lit(""))),
        "_lb_doc": F.xxhash64(ident, F.lit("place")),
        "_lb_size": document_bytes(text)})
    keys = cut(keyed.select("_lb_text", "_lb_doc", "_lb_size"))
    alike = keys.groupBy("_lb_text", "_lb_doc").agg(
        F.count("*").alias("n"), F.sum("_lb_size").alias("size"))
    found = alike.agg(F.sum("n").alias("n"), F.sum("size").alias("size"), F.max("n").alias("most"),
                      F.max(F.when(F.col("n") > 1, F.col("size"))).alias("largest")).first()
    within = max(1, int(tolerance * (found["size"] or 0) / shards))
    if (found["most"] or 0) > CELL_ROWS or (found["largest"] or 0) > within:
        # nothing but its place tells such a row from others; written once, it stays the same
        keyed = cut(keyed.withColumn("_lb_row", F.xxhash64(F.monotonically_increasing_id())))
        keys = keyed.select(*KEYS, "_lb_size")
    used = [k for k in KEYS if k in keyed.columns]
    borders = splitters(keys, shards, within)
    shard = sum((_after(s["path"], s["left"]).cast("int") for s in borders), F.lit(0))
    cells = max(1, -(-(found["n"] or 0) // (shards * CELL_ROWS)))
    cell = F.pmod(F.xxhash64(*used), F.lit(cells)).cast("long")
    # ranks are numbered per cell; what lies in the cells before is a table of shards * cells rows
    counts = keys.groupBy(shard.alias("shard"), cell.alias("_lb_cell")).agg(F.count("*").alias("n"))
    sums = (counts.withColumn("_lb_start", F.sum("n").over(
                Window.partitionBy("shard").orderBy("_lb_cell")) - F.col("n"))
            .select("shard", "_lb_cell", "_lb_start"))
    sums = F.broadcast(sums) if shards * cells * 32 <= SMALL else sums
    rank = F.row_number().over(Window.partitionBy("shard", "_lb_cell").orderBy(*reversed(used)))
    return (keyed.withColumns({"shard": shard, "_lb_cell": cell})
            .withColumn("_lb_rank", rank).join(sums, ["shard", "_lb_cell"])
            .withColumn("slot", F.col("_lb_start") + F.col("_lb_rank") - 1)
            .drop("_lb_start", "_lb_rank"))


@query("op7_shard_histogram")
def op7_shard_histogram(spark, sf_dir):
    """All documents in 8 shards of equal bytes; the digest columns of the contract."""
    docs = table(spark, sf_dir, "documents")
    slim = docs.select("doc_id", "text")
    placed = place(slim.select(
        "doc_id", "text", document_bytes(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")), 8, 1e-4)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
                         F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long"),
                         F.lit(None).cast("int").alias("grown_shard"))
