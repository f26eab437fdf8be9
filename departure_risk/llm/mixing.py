"""Mixing sources to target weights with a splitting tree.

1. The documents of a source are dealt into blocks by a hash of their id and text: a random, repeatable order of blocks.
2. A source's target is a number of words: whole passes over the source and a part of one more. In blocks, that is a
   quota of draws; the last draw is cut to the words that are still missing.
3. A tree splits the vector of quotas among the output shards: at each node the left half gets a multivariate
   hypergeometric draw without replacement of the node's blocks, so all orders of all draws are equally likely and every
   quota is met exactly. The leaves say how many blocks of each source a shard takes.
4. Shards take disjoint runs of each source's permuted draws and shuffle their documents.

Everything is columns and SQL functions. Tables of blocks, quotas and shards are small (at most MOST_BLOCKS blocks a
source); documents are shuffled as ids and sizes only.

Defined cases: a null text has size 0; a null source is a source of its own, last in order; documents of size 0 are
placed with their block and count no word; every row is a document of its own, those without an id or with a repeated one
too; other columns are ignored; an empty table gives an empty mix.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from departure_risk.session import written_once

WORD = r"[^\x20\x09-\x0D]+"
#: Words a block should hold, and blocks a source has at most; beyond that, blocks grow.
BLOCK_WORDS, MOST_BLOCKS = 50_000, 65_536
#: Blocks a shard should hold.
SHARD_BLOCKS = 32


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_mark(id_col: str, text_col: str, source_col: str) -> Column:
    """A hash of a document that rows without an id and rows that repeat one have by their text."""
    return F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(source_col).cast("string"))


def source_targets(sizes: DataFrame, weights: list[int], share: float, most: float) -> DataFrame:
    """source, source_size, target and docs: one row per source.

    `share` times all words is divided by weight (the weights repeat over the sources in order); a target stops at
    `most` times its source's size and the excess is divided again until none is above. That ends at the one level
    where the targets, least(most * size, level * weight), add up to the whole, so the level is found by sorting
    sources by the level at which they stop.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(in_order) - 1) % len(weights)
    weighed = by_source.withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))).withColumns({
            "top": F.lit(float(most)) * F.col("source_size"), "stops": F.lit(float(most)) * F.col("source_size") / F.col("weight")})
    whole = Window.partitionBy()
    stopping = Window.orderBy("stops", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    staged = weighed.withColumns({
        "goal": F.least(F.lit(float(share)) * F.sum("source_size").over(whole), F.sum("top").over(whole)),
        "stopped": F.coalesce(F.sum("top").over(stopping), F.lit(0.0)),
        "going": F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(stopping), F.lit(0.0))})
    level = (F.col("goal") - F.col("stopped")) / F.col("going")
    leveled = staged.withColumn("level", F.max(F.when(level <= F.col("stops"), level)).over(whole))
    target = F.least(F.col("top"), F.coalesce(F.col("level"), F.lit(float("inf"))) * F.col("weight"))
    return leveled.select("source", "source_size", target.alias("target"), "docs")


def hypergeometric(of_kind: str, total: str, drawn: str, uniform: str) -> str:
    """SQL for how many of `of_kind` special items are among `drawn` of `total`, from one uniform number.

    Inversion from the most likely value outwards: probabilities relative to it follow from their ratios. Values more
    than 12 standard deviations away, with less probability than a double can tell, are not visited.
    """
    k, n, m = of_kind, total, drawn
    low, high = f"greatest(0L, {m} - ({n} - {k}))", f"least({k}, {m})"
    mode = f"greatest({low}, least({high}, cast(floor(({m} + 1.0D) * ({k} + 1.0D) / ({n} + 2.0D)) as bigint)))"
    reach = (f"cast(12 * sqrt({m} * ({k} / cast({n} as double)) * (1 - {k} / cast({n} as double)) * ({n} - {m})"
             f" / greatest({n} - 1.0D, 1.0D)) as bigint) + 12")
    up = f"(({k} - x) * cast({m} - x as double) / ((x + 1.0D) * ({n} - {k} - {m} + x + 1.0D)))"
    down = f"(x * cast({n} - {k} - {m} + x as double) / (({k} - x + 1.0D) * ({m} - x + 1.0D)))"
    ups = f"if(b > mode, sequence(mode, b - 1), cast(array() as array<bigint>))"
    downs = f"if(a < mode, sequence(mode, a + 1, -1L), cast(array() as array<bigint>))"
    start, none = "named_struct('p', 1.0D, 's', 0.0D)", "cast(null as bigint)"
    total_of = lambda steps, ratio: f"aggregate({steps}, {start}, (acc, x) -> named_struct('p', acc.p * {ratio}, 's', acc.s + acc.p * {ratio}), acc -> acc.s)"
    walk = lambda steps, ratio, first, move: (
        f"aggregate({steps}, named_struct('p', 1.0D, 'left', {first}, 'at', {none}), (acc, x) -> if(acc.at is not null, acc,"
        f" named_struct('p', acc.p * {ratio}, 'left', acc.left - acc.p * {ratio},"
        f" 'at', if(acc.left - acc.p * {ratio} < 0, {move}, {none}))), acc -> acc.at)")
    bind = lambda value, name, body: f"element_at(transform(array({value}), {name} -> {body}), 1)"
    found = (f"case when t < 1 then mode when t < 1 + above then coalesce({walk(ups, up, '(t - 1)', 'x + 1')}, b)"
             f" else coalesce({walk(downs, down, '(t - 1 - above)', 'x - 1')}, a) end")
    body = bind(total_of(ups, up), "above", bind(total_of(downs, down), "below",
                bind(f"{uniform} * (1 + above + below)", "t", found)))
    ranged = bind(f"greatest({low}, mode - ({reach}))", "a", bind(f"least({high}, mode + ({reach}))", "b", body))
    return f"if({m} <= 0 or {k} <= 0, 0L, if({m} >= {n}, {k}, {bind(mode, 'mode', ranged)}))"


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """shard, number (of the source) and takes, the draws of the source that the shard gets.

    `quotas` is one row, the root: the arrays numbers and quotas, an entry per source. Each round splits every node of more than one shard in two, so there are log2(shards)
    rounds on at most `shards` rows. A round draws, source after source, how many of the source's blocks go left.
    """
    nodes = quotas.select(F.lit(0).cast("long").alias("first"), F.lit(shards).cast("long").alias("width"), "quotas", "numbers")
    uniform = f"(pmod(xxhash64(first, width, st.i, {seed}L), 9007199254740992L) / 9007199254740992.0D)"
    draw = hypergeometric("q", "st.total", "st.slots", uniform)
    left = (
        "aggregate(quotas, named_struct('i', 0L, 'total', blocks, 'slots', slots_left, 'out', cast(array() as array<bigint>)),"
        f" (st, q) -> element_at(transform(array({draw}), got -> named_struct('i', st.i + 1, 'total', st.total - q,"
        " 'slots', st.slots - got, 'out', concat(st.out, array(got)))), 1), st -> st.out)")
    while shards > 1:
        shards = -(-shards // 2)
        sized = nodes.withColumn("blocks", F.expr("aggregate(quotas, 0L, (a, q) -> a + q)")).withColumn(
            "slots_left", F.expr("if(width > 1, cast(round(blocks * (cast(width / 2 as bigint) / cast(width as double))) as bigint), blocks)"))
        taken = sized.withColumn("lefts", F.when(F.col("width") > 1, F.expr(left)).otherwise(F.col("quotas")))
        halves = F.expr(
            "if(width > 1, array(named_struct('first', first, 'width', cast(width / 2 as bigint), 'quotas', lefts),"
            " named_struct('first', first + cast(width / 2 as bigint), 'width', width - cast(width / 2 as bigint),"
            " 'quotas', zip_with(quotas, lefts, (q, l) -> q - l))), array(named_struct('first', first, 'width', width, 'quotas', quotas)))")
        nodes = taken.select(F.explode(halves).alias("half"), "numbers").select("half.*", "numbers")
    return nodes.select(F.col("first").alias("shard"), F.explode(F.arrays_zip("numbers", "quotas")).alias("z")).select(
        "shard", F.col("z.numbers").alias("number"), F.col("z.quotas").alias("takes"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 7,
        block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The sizes (row, doc_id, mark, source, size), the targets (source, source_size, target, docs) and the mix.

    The mix has a row for each drawn copy of a document: row, doc_id, mark, source, shard, position (its place in the shard),
    copy (0 for the first pass over its source, then 1, ...), size and words (its size, or less where the draw is cut).
    `row` numbers the rows of this call, `mark` is the same in all calls.
    """
    sizes = written_once(docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), row_mark(id_col, text_col, source_col).alias("mark"),
        F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size")), "mix-sizes")
    targets = written_once(source_targets(sizes, list(weights), share, most).withColumn(
        "number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).withColumn(
        "blocks", F.greatest(F.lit(1), F.least(F.lit(MOST_BLOCKS), F.ceil(F.col("source_size") / block_words))).cast("long")),
        "mix-targets")
    numbered = sizes.join(targets.select("source", "number", "blocks"), sizes["source"].eqNullSafe(targets["source"])).select(
        "row", "doc_id", "mark", sizes["source"], "size", "number", F.pmod(F.xxhash64("mark", F.lit(seed)), F.col("blocks")).alias("block"))
    # empty blocks can be no draw: those that hold words are numbered anew, in order
    filled = numbered.groupBy("number", "block").agg(F.sum("size").alias("words")).where("words > 0")
    in_source = Window.partitionBy("number").orderBy("block")
    blocks = written_once(filled.select(
        "number", "block", "words", (F.row_number().over(in_source) - 1).alias("draw"),
        (F.sum("words").over(in_source) - F.col("words")).alias("before")), "mix-blocks")
    counted = blocks.groupBy("number").agg(F.count(F.lit(1)).alias("filled"))
    wanted = F.round(F.col("target")).cast("long")
    passes = targets.join(counted, "number").select(
        "number", "source_size", "filled", wanted.alias("wanted"), F.expr("cast(round(target) as bigint) div nullif(source_size, 0)").alias("passes"))
    # draws: blocks of whole passes, and those of the last pass that begin before its words are used up
    draws = written_once(blocks.join(passes, "number").withColumn(
        "copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("passes")))).withColumn(
        "left", F.when(F.col("copy") < F.col("passes"), F.col("words")).otherwise(
            F.least(F.col("words"), F.col("wanted") - F.col("passes") * F.col("source_size") - F.col("before")))).where("left > 0").select(
        "number", "block", "copy", "left", (F.col("copy") * F.col("filled") + F.col("draw")).alias("place")), "mix-draws")
    totals = draws.groupBy("number").agg(F.count(F.lit(1)).alias("quota"))
    gathered = written_once(totals.agg(F.sort_array(F.collect_list(F.struct("number", "quota"))).alias("sources")).select(
        F.col("sources.number").alias("numbers"), F.col("sources.quota").alias("quotas")), "mix-quotas")
    total = gathered.select(F.expr("aggregate(quotas, 0L, (a, q) -> a + q)")).first()[0]  # one number
    shards = max(1, -(-total // shard_blocks))
    per_shard = split_quotas(gathered, shards, seed)
    order = Window.partitionBy("number").orderBy("shard")
    # a shard's draws of a source are consecutive: one row for each, so draws meet their shard by equality
    assigned = per_shard.where("takes > 0").withColumn("until", F.sum("takes").over(order)).select(
        "number", "shard", F.explode(F.sequence(F.col("until") - F.col("takes"), F.col("until") - 1)).alias("place"))
    drawn = written_once(draws.join(assigned, ["number", "place"]).select("number", "block", "copy", "left", "shard"), "mix-shards")
    copies = numbered.join(drawn, ["number", "block"])
    in_block = Window.partitionBy("number", "block", "copy").orderBy(
        F.xxhash64("mark", F.lit(seed + 1)), "mark", "row").rowsBetween(Window.unboundedPreceding, -1)
    cut = copies.withColumn("words", F.least(F.col("size"), F.greatest(
        F.lit(0).cast("long"), F.col("left") - F.coalesce(F.sum("size").over(in_block), F.lit(0)))))
    in_shard = Window.partitionBy("shard").orderBy(F.xxhash64("mark", "copy", F.lit(seed + 2)), "mark", "copy", "row")
    mixed = cut.where("words > 0 or size = 0").select(
        "row", "doc_id", "mark", "source", "shard", (F.row_number().over(in_shard) - 1).cast("long").alias("position"), "copy", "size", "words")
    return sizes, targets, mixed


def mix_words(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, size, source_size, target and taken, the words that the mix takes of it."""
    sizes, targets, mixed = mix(docs, **options)
    taken = mixed.groupBy("row").agg(F.sum("words").alias("taken"))
    rows = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).select("row", "doc_id", "size", "source_size", "target")
    return rows.join(taken, "row", "left").select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The documents as the mix takes them, whole and with all their columns: a row for each copy, none for those left out.

    The last draw of a source ends with the document that comes nearest to its target. Of rows that are equal in id, text
    and source, each copy is one of them.
    """
    _, _, mixed = mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)

    def key(frame: DataFrame, doc_id: Column, source: Column) -> DataFrame:
        return frame.withColumns({"id_key": F.coalesce(doc_id.cast("long"), F.lit(0)), "source_key": F.coalesce(source.cast("string"), F.lit(""))})

    keys = ["mark", "id_key", "source_key"]
    drawn = key(mixed.where("2 * words >= size"), F.col("doc_id"), F.col("source")).groupBy(*keys).agg(F.count(F.lit(1)).alias("drawn"))
    rows = key(docs.select(F.struct(*docs.columns).alias("doc"), row_mark(id_col, text_col, source_col).alias("mark")),
               F.col("doc")[id_col], F.col("doc")[source_col])
    same = Window.partitionBy(*keys)
    numbered = rows.withColumns({"number": F.row_number().over(same.orderBy("mark")) - 1, "rows": F.count(F.lit(1)).over(same)})
    joined = numbered.join(drawn, keys).withColumn("copies", F.expr("drawn div rows + if(number < drawn % rows, 1, 0)")).where("copies > 0")
    return joined.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("doc.*")
