"""Operator 11: the prefix trie of rebuilt conversations, by composable monoid fingerprints.

A conversation c is rebuilt from the first h turns of its base and its own turns after the first h. No rebuilt
text is made. The fingerprint of a sequence of turns is (sum of t_i * R**i, length) in four fields of integers
modulo primes below 2**31; (a, n) * (b, m) = (a + R**n * b, n + m) joins two sequences, and a stretch of one is
the difference of two of its prefixes. So every rebuilt prefix is had from two prefixes of stored
conversations: the base's first h turns, and the own turns up to there less the first h.

Rows of turns are sorted by range, so that a conversation of any length spreads over partitions. Each chunk of
at most ``CHUNK`` turns is hashed by itself, and the chunks of a conversation are then joined by the monoid.
Rebuilt prefixes of one depth and fingerprint are a node. Each holds a reference to its last turn, as the
conversation and place where it is stored, and the SHA-256 read there; a node is right if all its members have one such digest and
one parent fingerprint, which by induction makes their prefixes equal. If two differ, all is hashed again with
other factors, so the result is exact.

A node belongs to its smallest member, so the nodes of a conversation are one way down. Ways hang on each
other; sums over subtrees take a pointer-doubling pass over ways, in rounds logarithmic in their nesting,
and running sums down each way, in chunks. Ids that end at a node are written in blocks of ids and hashed as a stream.

Turns are ordered by turn (null first), role and text; repeated rows are turns of their own. A null role or text
is empty. Rows without a conversation id take no part. Other columns play no part. An empty table has
no trie: no rows.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from foldwise.llm.common import kept

PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)  # the four largest below 2**31
LANES, CHUNK, IDS = range(4), 1 << 16, 12
SUMS = tuple(f"s{k}" for k in LANES)
BEFORE = tuple(f"b{k}" for k in LANES)
HEAD = 5


def factors(seed: int) -> list[int]:
    return [int(x) for x in np.random.default_rng((11, seed)).integers(1 << 20, 1 << 30, len(LANES))]


def sums(values: np.ndarray, r: int, prime: int, powers: np.ndarray, place: np.ndarray, first: np.ndarray, carry: int) -> tuple[np.ndarray, np.ndarray]:
    """Running sums of values * r**place modulo ``prime`` that begin anew where ``first`` says; and those before each row."""
    terms = values % prime * powers[place] % prime
    total = np.cumsum(terms)
    starts = np.flatnonzero(first)
    base = np.zeros(len(values), dtype=np.int64) - carry
    if len(starts):
        base[starts[0] :] = np.repeat(total[starts] - terms[starts], np.diff(np.append(starts, len(values))))
    inclusive = (total - base) % prime
    return inclusive, (inclusive - terms) % prime


def hashed(turns: DataFrame, seed: int) -> DataFrame:
    """``conv``, ``r`` (place from 1), ``chars``, ``digest``, and the fingerprints up to the turn (s0..s3) and before
    it (b0..b3), for all stored turns; written once."""
    spark = turns.sparkSession
    empty = F.lit("")
    rows = turns.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"), F.monotonically_increasing_id().alias("row")
    )
    order = ["conv", "turn", "role", "text", "row"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    digest = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    lanes = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"t{k}") for k in LANES]
    slim = ordered.select("conv", F.spark_partition_id().alias("part"), F.char_length("text").cast("long").alias("chars"), F.unhex(digest).alias("digest"), *lanes)
    base = factors(seed)

    def run(batches):
        powers = []
        for r, prime in zip(base, PRIMES, strict=True):
            own = np.ones(CHUNK + 1, dtype=np.int64)
            for i in range(1, CHUNK + 1):
                own[i] = own[i - 1] * r % prime
            powers.append(own)
        last, count, carry = None, 0, [0] * len(LANES)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = batch.column(0).to_numpy()
            first = np.ones(n, bool)
            first[1:] = conv[1:] != conv[:-1]
            first[0] = last is None or conv[0] != last
            starts = np.flatnonzero(first)
            place = np.arange(n) + count
            if len(starts):
                place[starts[0] :] = np.arange(starts[0], n) - np.repeat(starts, np.diff(np.append(starts, n)))
            j = place % CHUNK + 1
            out = [batch.column(0), pa.array((batch.column(1).to_numpy().astype(np.int64) << 32) + place // CHUNK), pa.array(j), batch.column(2), batch.column(3)]
            up = [sums(batch.column(4 + k).to_numpy(), base[k], PRIMES[k], powers[k], j, j == 1, carry[k]) for k in LANES]
            out += [pa.array(s) for s, _ in up] + [pa.array(b) for _, b in up]
            last, count, carry = conv[-1], int(place[-1]) + 1, [int(s[-1]) for s, _ in up]
            yield pa.RecordBatch.from_arrays(out, names=["conv", "chunk", "j", "chars", "digest", *SUMS, *BEFORE])

    shape = "conv long, chunk long, j long, chars long, digest binary, " + ", ".join(f"{c} long" for c in SUMS + BEFORE)
    return kept(slim.mapInArrow(run, shape), "turns")


def joined(local: DataFrame, seed: int) -> DataFrame:
    """Joins the chunks of a conversation. Only those of conversations in more than one chunk are looked at: two a
    partition and one for ``CHUNK`` turns."""
    base = factors(seed)
    totals = local.groupBy("conv", "chunk").agg(F.max("j").alias("n"), *[F.max_by(c, "j").alias(c) for c in SUMS])
    several = totals.withColumn("chunks", F.count("*").over(W.partitionBy("conv"))).filter("chunks > 1").drop("chunks")

    def run(pdf):
        pdf = pdf.sort_values("chunk")
        n, out, state = 0, [], [0] * len(LANES)
        for row in pdf.itertuples(index=False):
            power = [pow(r, n, prime) for r, prime in zip(base, PRIMES, strict=True)]
            out.append((row.conv, row.chunk, n, *state, *power))
            state = [(a + p * getattr(row, c)) % prime for a, p, c, prime in zip(state, power, SUMS, PRIMES, strict=True)]
            n += row.n
        return type(pdf)(out, columns=["conv", "chunk", "n0", *[f"o{k}" for k in LANES], *[f"p{k}" for k in LANES]])

    shape = "conv long, chunk long, n0 long, " + ", ".join(f"{c}{k} long" for c in "op" for k in LANES)
    whole = local.join(several.groupBy("conv").applyInPandas(run, shape), ["conv", "chunk"], "left")
    shift = lambda c, k: F.when(F.col("n0").isNull(), F.col(c)).otherwise((F.col(f"o{k}") + F.col(f"p{k}") * F.col(c)) % PRIMES[k])
    moved = [shift(f"{x}{k}", k).alias(f"{x}{k}") for x in "sb" for k in LANES]
    return kept(whole.select("conv", (F.col("j") + F.coalesce("n0", F.lit(0))).alias("r"), "chars", "digest", *moved), "prefixes")


def packed(lanes: list[Column]) -> list[Column]:
    """Four lanes as two longs."""
    return [F.shiftleft(lanes[0], 31) + lanes[1], F.shiftleft(lanes[2], 31) + lanes[3]]


def rebuilt(turns: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Every turn of every rebuilt conversation as ``conv``, ``d``, fingerprints up to it (hi, lo) and before it (phi,
    plo), ``src`` and ``r`` (where it is stored), ``chars``, ``digest``; and the conversations with their length."""
    base = factors(seed)
    full = joined(hashed(turns, seed), seed)
    sizes = full.groupBy("conv").agg(F.max("r").alias("n"))
    head = full.filter(F.col("r") <= HEAD)
    hop = (F.crc32(F.col("conv").cast("string").cast("binary")) % (HEAD + 1)).cast("int")
    convs = sizes.withColumn("h", hop).withColumn("base", F.col("conv") - F.col("conv") % 100)
    convs = convs.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("nb")), "base", "left").withColumn("hh", F.least("h", F.coalesce("nb", F.lit(0))).cast("int"))
    lanes = lambda c, name: head.select(F.col("conv").alias(c), F.col("r").alias("at"), *[F.col(f"s{k}").alias(f"{name}{k}") for k in LANES])
    convs = convs.join(lanes("base", "x").withColumnRenamed("at", "hh"), ["base", "hh"], "left").join(lanes("conv", "y").withColumnRenamed("at", "h"), ["conv", "h"], "left")
    convs = convs.na.fill(0, [f"{c}{k}" for c in "xy" for k in LANES])
    convs = kept(convs.withColumn("length", F.col("hh") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "convs")
    theirs = convs.filter("hh > 0").select("conv", F.col("base").alias("src"), "hh", "length")
    first = theirs.join(head.withColumnRenamed("conv", "src"), "src").filter("r <= hh").withColumn("d", F.col("r"))
    own = full.join(convs.drop("n"), "conv").filter("r > h").withColumn("d", F.col("hh") + F.col("r") - F.col("h")).withColumn("src", F.col("conv"))
    for k in LANES:  # R**(hh - h): the base may have fewer than h turns
        back = F.element_at(F.array(*[F.lit(pow(base[k], -i, PRIMES[k])) for i in range(HEAD + 1)]), F.col("h") - F.col("hh") + 1)
        for c in "sb":
            own = own.withColumn(f"{c}{k}", (F.col(f"x{k}") + F.pmod(F.col(f"{c}{k}") - F.col(f"y{k}"), F.lit(PRIMES[k])) * back) % PRIMES[k])
    (hi, lo), (phi, plo) = (packed([F.col(f"{c}{k}") for k in LANES]) for c in "sb")
    columns = ["conv", F.col("d").cast("long").alias("d"), hi.alias("hi"), lo.alias("lo"), phi.alias("phi"), plo.alias("plo"), "src", "r", "chars", "digest", (F.col("d") == F.col("length")).alias("ends")]
    return kept(first.select(*columns).unionByName(own.select(*columns)), "rebuilt"), convs


def end_hashes(ends: DataFrame, key: list[str]) -> DataFrame:
    """SHA-256 of the ids that end at a node: ids are joined in blocks of 2**IDS, and the blocks hashed in order
    as they stream by, so that no list of ids is ever whole."""
    blocks = ends.groupBy(*key, F.shiftright("conv", IDS).alias("block")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    ordered = blocks.repartition(*key).sortWithinPartitions(*key, "block")

    def run(batches):
        node, sha = None, None
        for batch in batches:
            out = []
            for *at, ids in zip(*[batch.column(c).to_pylist() for c in (*key, "ids")], strict=True):
                if at != node:
                    if node:
                        out.append((*node, sha.hexdigest()))
                    node, sha = at, hashlib.sha256(ids.encode())
                else:
                    sha.update(f",{ids}".encode())
            if out:
                yield made(out)
        if node:
            yield made([(*node, sha.hexdigest())])

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == len(key) else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))], names=[*key, "ends_sha256"])

    return ordered.mapInArrow(run, ", ".join(f"{k} long" for k in key) + ", ends_sha256 string")


def subtrees(ways: DataFrame) -> DataFrame:
    """``conv``, ``up`` (the way it hangs on, null for the top), ``saved``, ``leaves``: sums over all ways below, by doubling."""
    now = kept(ways, "ways")
    while not now.filter("up is not null").isEmpty():
        more = now.filter("up is not null").groupBy(F.col("up").alias("conv")).agg(F.sum("saved").alias("s"), F.sum("leaves").alias("l"))
        above = now.select(F.col("conv").alias("up"), F.col("up").alias("next"))
        now = now.join(more, "conv", "left").join(above, "up", "left")
        now = kept(now.select("conv", F.col("next").alias("up"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"), (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves")), "ways")
    return now.drop("up")


def downward(nodes: DataFrame, columns: list[str], step: int = 1024) -> DataFrame:
    """Replaces ``columns`` by their sums over the way from the node down, in chunks of ``step`` depths."""
    cut = nodes.withColumn("cut", F.expr(f"depth div {step}"))
    within = W.partitionBy("conv", "cut").orderBy(F.desc("depth"))
    beyond = W.partitionBy("conv").orderBy(F.desc("cut")).rowsBetween(W.unboundedPreceding, -1)
    chunks = cut.groupBy("conv", "cut").agg(*[F.sum(c).alias(c) for c in columns])
    chunks = chunks.select("conv", "cut", *[F.coalesce(F.sum(c).over(beyond), F.lit(0)).alias(f"{c}_beyond") for c in columns])
    summed = cut.select(*[c for c in cut.columns if c not in columns], *[F.sum(c).over(within).alias(c) for c in columns])
    return summed.join(chunks, ["conv", "cut"]).select(*[c for c in nodes.columns if c not in columns], *[(F.col(c) + F.col(f"{c}_beyond")).alias(c) for c in columns])


def verified(turns: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rebuilt turns, conversations and nodes, with factors under which no two different prefixes meet."""
    seed = 0
    while True:
        rows, convs = rebuilt(turns, seed)
        parent = F.struct("phi", "plo")
        nodes = rows.groupBy("d", "hi", "lo").agg(
            F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.max("chars").alias("chars"), F.min(F.struct("src", "r")).alias("last_turn"),
            F.min(parent).alias("parent"), F.max(parent).alias("parent_too"), F.min("digest").alias("digest"), F.max("digest").alias("digest_too"),
        )
        nodes = kept(nodes, "nodes")
        if nodes.filter("digest <> digest_too or parent <> parent_too").isEmpty():
            return rows, convs, nodes.select("d", "hi", "lo", "conv", "n_convs", "chars", "last_turn", "parent.phi", "parent.plo")
        seed += 1


def trie(turns: DataFrame) -> DataFrame:
    """A row for each node of the trie of rebuilt conversations: see the module's text and the registered query.
    ``last_src``, ``last_r`` say where the node's last turn is stored (null for the root)."""
    rows, convs, nodes = verified(turns)
    key = ["d", "hi", "lo"]
    zero = F.lit(0).cast("long")
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).filter("conv is not null")
    nodes = nodes.unionByName(root.select(*[zero.alias(c) for c in key], "conv", "n_convs", zero.alias("chars")), allowMissingColumns=True)
    turnless = convs.filter("length = 0").select("conv", *[zero.alias(c) for c in key])
    ends = end_hashes(rows.filter("ends").select("conv", *key).unionByName(turnless), key)
    nodes = nodes.withColumn("weight", (F.col("n_convs") - 1) * F.col("chars"))
    way = nodes.groupBy("conv").agg(F.min("d").alias("top"), F.max("d").alias("bottom"), F.min_by(F.struct("phi", "plo"), "d").alias("parent"), F.sum("weight").alias("saved"))
    over = nodes.select((F.col("d") + 1).alias("top"), F.col("hi").alias("phi"), F.col("lo").alias("plo"), F.col("conv").alias("up"))
    way = way.select("conv", "top", "bottom", "saved", "parent.*").join(over, ["top", "phi", "plo"], "left").select("conv", "top", "bottom", "saved", "up")
    way = kept(way, "way")
    hanging = way.filter("up is not null").groupBy(F.col("up").alias("conv"), (F.col("top") - 1).alias("d")).agg(F.count("*").alias("hang"))
    ends_below = way.join(hanging.withColumnRenamed("d", "bottom"), ["conv", "bottom"], "left")
    below = subtrees(ends_below.select("conv", "up", "saved", F.when(F.col("hang").isNull(), 1).otherwise(0).cast("long").alias("leaves")))
    attached = way.filter("up is not null").select("conv", "up", (F.col("top") - 1).alias("d")).join(below, "conv")
    attached = attached.groupBy(F.col("up").alias("conv"), "d").agg(F.count("*").alias("hang"), F.sum("saved").alias("s"), F.sum("leaves").alias("l"))
    each = nodes.join(ends, key, "left").join(way.select("conv", "top", "bottom", "up"), "conv").join(attached, ["conv", "d"], "left").na.fill(0, ["hang", "s", "l"])
    children = F.col("hang") + (F.col("d") < F.col("bottom")).cast("long")
    each = each.select(
        "conv", F.col("d").alias("depth"), F.when(F.col("d") > F.col("top"), F.col("conv")).otherwise(F.col("up")).alias("parent_conv_id"), "n_convs", children.alias("n_children"),
        F.col("last_turn.src").alias("last_src"), F.col("last_turn.r").alias("last_r"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        ((children == 0).cast("long") + F.col("l")).alias("n_leaves"), (F.col("weight") + F.col("s")).alias("saved_tokens"),
    )
    out = downward(each, ["n_leaves", "saved_tokens"])
    return out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "last_src", "last_r")
