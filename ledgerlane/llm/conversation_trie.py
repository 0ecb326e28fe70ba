"""Prefix trie of conversations: blocks of several turns first, single turns only where siblings part.

Turns become digests. Digests of ``BLOCK`` successive turns make a block; what a conversation's blocks
up to some place combine to names the block node it reaches. Conversations are grouped by these
names. Below a block node from which all go on with the same block, the nodes in between have that
block's members; only where blocks differ are the turns inside them compared.

No tree is walked. A conversation owns the nodes whose smallest member it is: always the last ones of
its path. So sums over a subtree are sums over its members, of what each has left from there on and of
what it owns of that.

No group is gathered whole. Positions and running digests of one conversation are found by sections of
bounded length, and totals of sections are carried on; members are counted before they are shuffled;
parents with very many children are few and found apart.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlane.llm.common import stored

BLOCK = 4  # turns
SECTION = 256  # blocks
TURN_BITS = 10  # of turn numbers that share a section of the table as given
ID_BITS = 12  # of conversation ids whose list makes one piece of text
HOT_SHARE = 1000

_WORD = "[^\\\\x20\\\\x09-\\\\x0D]+"
_NO_TURN = -(1 << 62)


def _digest(parts: Column) -> Column:
    """Sixteen bytes of SHA-256."""
    return F.unhex(F.substring(F.sha2(parts.cast("binary"), 256), 1, 32))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, digest, words, n): equal rows once, with the times they come. No text goes on."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in ("role", "text"))
    digest = _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        digest.alias("digest"), F.expr(f"regexp_count(coalesce(text, ''), '{_WORD}')").cast("long").alias("words"),
    )
    return rows.groupBy("conv_id", "turn", "digest", "words").agg(F.count("*").alias("n"))


def _before(column: str, window: Window) -> Column:
    return F.coalesce(F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def rebuilt(conversations: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like their neighbours: sequences (conv_id, pos, digest, words), and
    conv_id of all conversations, those without a turn among them.

    The first h turns come from conversation c - c % every, the rest are c's own after its first h;
    h is the CRC-32 of the decimal id modulo ``most``. Turns are ordered by number, null first, then by
    digest. ``c % every`` has the sign of c.
    """
    rows = stored(turns(conversations), "trie-turns")
    rows = rows.withColumn("part", F.coalesce(F.shiftright("turn", TURN_BITS), F.lit(_NO_TURN)))
    parts = rows.groupBy("conv_id", "part").agg(F.sum("n").alias("size"))
    parts = parts.withColumn("before", _before("size", Window.partitionBy("conv_id").orderBy("part")))
    within = Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), "digest", "words")
    placed = rows.withColumn("inside", _before("n", within))

    opening = (
        placed.where(F.col("conv_id") % every == 0).join(parts.select("conv_id", "part", "before"), ["conv_id", "part"])
        .withColumn("at", F.col("before") + F.col("inside")).where(F.col("at") < most - 1)
        .withColumn("at", F.explode(F.sequence("at", F.least(F.col("at") + F.col("n"), F.lit(most - 1)) - 1)))
        .groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "digest", "words"))).alias("opening"))  # most - 1 at most
    )
    ids = parts.groupBy("conv_id").agg(F.sum("size").alias("total")).withColumns({
        "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % most,
        "base": F.col("conv_id") - F.col("conv_id") % every,
    })
    opened = ids.join(opening, "base", "left").select(
        "conv_id", "h", F.slice(F.coalesce("opening", F.array().cast("array<struct<at:bigint,digest:binary,words:bigint>>")), F.lit(1), F.col("h").cast("int")).alias("opening"),
    )
    opened = stored(opened, "trie-openings")

    first = opened.select("conv_id", F.explode("opening").alias("t")).select(
        "conv_id", F.col("t.at").alias("pos"), "t.digest", "t.words"
    )
    moved = parts.join(opened.select("conv_id", "h", F.size("opening").alias("opened")), "conv_id")
    start = F.greatest(F.col("before") + F.col("inside"), F.col("h"))
    stop = F.col("before") + F.col("inside") + F.col("n") - 1
    own = (
        placed.join(moved.select("conv_id", "part", "before", "h", "opened"), ["conv_id", "part"])
        .where(stop >= start).withColumn("at", F.explode(F.sequence(start, stop)))
        .select("conv_id", (F.col("at") - F.col("h") + F.col("opened")).alias("pos"), "digest", "words")
    )
    return first.unionByName(own), opened.select("conv_id")


def _blocks(sequences: DataFrame) -> DataFrame:
    """Per conversation and block: its turns, the names of the block nodes before (p1, p2) and after it
    (c1, c2), words that are left after it, and whether it is the last."""
    number = F.expr(f"pos div {BLOCK}")
    rows = sequences.withColumns({"block": number, "section": F.expr(f"pos div {BLOCK * SECTION}")})
    rows = rows.repartition("conv_id", "section").groupBy("conv_id", "section", "block").agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("turns")  # BLOCK at most
    )
    rows = rows.withColumns({
        "digests": F.col("turns.digest"), "words": F.col("turns.words"),
        "in_block": F.aggregate("turns.words", F.lit(0).cast("long"), lambda a, b: a + b),
    }).drop("turns")
    whole = _digest(F.array_join(F.transform("digests", F.hex), ""))
    rows = rows.withColumn("digest", whole).withColumns({
        f"x{k}": F.xxhash64(F.lit(k), "block", "digest") for k in (1, 2)
    })
    section = Window.partitionBy("conv_id", "section").orderBy("block")
    running = section.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({
        "r1": F.bit_xor("x1").over(running), "r2": F.bit_xor("x2").over(running), "so_far": F.sum("in_block").over(running),
        "ends_section": F.lead("block").over(section).isNull(),
    })
    totals = rows.groupBy("conv_id", "section").agg(
        F.bit_xor("x1").alias("t1"), F.bit_xor("x2").alias("t2"), F.sum("in_block").alias("held"),
    )
    order = Window.partitionBy("conv_id").orderBy("section")
    earlier, later = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    totals = totals.withColumns({
        "b1": F.coalesce(F.bit_xor("t1").over(earlier), F.lit(0)), "b2": F.coalesce(F.bit_xor("t2").over(earlier), F.lit(0)),
        "left_here": F.sum("held").over(later), "last_section": F.lead("section").over(order).isNull(),
    }).drop("t1", "t2", "held")
    joined = rows.join(totals, ["conv_id", "section"])
    named = joined.withColumns({f"c{k}": F.col(f"b{k}").bitwiseXOR(F.col(f"r{k}")) for k in (1, 2)})
    return named.select(
        "conv_id", "section", "block", "digests", "words",
        *(F.col(f"c{k}").bitwiseXOR(F.col(f"x{k}")).alias(f"p{k}") for k in (1, 2)), "c1", "c2",
        (F.col("left_here") - F.col("so_far")).alias("rest"), (F.col("ends_section") & F.col("last_section")).alias("last"),
    )


def _name(k: int, off: Column) -> Column:
    """One half of the name of the node after ``off`` turns of a block."""
    inner = F.xxhash64(F.lit(k + 2), "p1", "p2", off, F.slice("digests", F.lit(1), off))
    return F.when(off == BLOCK, F.col(f"c{k}")).otherwise(inner)


def _turn_nodes(edges: DataFrame) -> DataFrame:
    """One row per turn of each distinct block: id, parent's id, depth, words of the turn and from it on."""
    rows = edges.withColumn("off", F.explode(F.sequence(F.lit(1), F.size("digests"))))
    off = F.col("off")
    tail = F.aggregate(F.slice("words", off, F.lit(BLOCK)), F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.withColumns({
        "n1": _name(1, off), "n2": _name(2, off),
        "o1": F.when(off == 1, F.col("p1")).otherwise(_name(1, off - 1)),
        "o2": F.when(off == 1, F.col("p2")).otherwise(_name(2, off - 1)),
        "depth": F.col("block") * BLOCK + off, "turn_words": F.element_at("words", off), "tail": tail,
    })


def _refined(rows: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Turn nodes of blocks without siblings as they are; those of blocks with siblings grouped."""
    alone = rows.where("alone").select("n1", "n2", *[F.expr(arg).alias(name) for name, (arg, _) in sums.items()])
    parted = rows.where("NOT alone").groupBy("n1", "n2").agg(*[agg(F.expr(arg)).alias(name) for name, (arg, agg) in sums.items()])
    return alone.unionByName(parted)


def _parents(nodes: DataFrame, total: int) -> DataFrame:
    """Each node with its parent's conv_id.

    A node with more than a thousandth of all children is one of fewer than a thousand, so those are
    broadcast; all other parents meet their children in a join without a hot key.
    """
    above = nodes.select(F.col("n1").alias("o1"), F.col("n2").alias("o2"), F.col("m").alias("parent_conv_id"), "n_children")
    hot = F.col("n_children") * HOT_SHARE > total
    few = F.broadcast(above.where(hot).drop("n_children"))
    below = nodes.where("depth > 0")
    many = below.join(few, ["o1", "o2"])
    rest = below.join(few, ["o1", "o2"], "left_anti").join(above.where(~hot).drop("n_children"), ["o1", "o2"])
    return many.unionByName(rest)


def _hashed_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each node's list, which come in order; only the hash is held."""
    def out(key, digest):
        values = [pa.array([v], pa.int64()) for v in key]
        return pa.RecordBatch.from_arrays([*values, pa.array([digest.hexdigest()])], names=["n1", "n2", "ends_sha256"])

    key, digest, done = None, None, []
    for batch in batches:
        for n1, n2, piece in zip(*(batch.column(k).to_pylist() for k in ("n1", "n2", "piece")), strict=True):
            if (n1, n2) != key:
                if key is not None:
                    done.append(out(key, digest))
                key, digest = (n1, n2), hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        if len(done) > 1000:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
            done = []
    if key is not None:
        done.append(out(key, digest))
        yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]


def _ends(ends: DataFrame) -> DataFrame:
    """(n1, n2, ends_sha256) of the ascending ids that end at each node.

    Ids are sorted and joined in pieces of neighbouring ids, which hold no more than 4,096 each.
    """
    pieces = ends.groupBy("n1", "n2", F.shiftright("conv_id", ID_BITS).alias("at")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("piece")
    )
    dealt = pieces.repartition("n1", "n2").sortWithinPartitions("n1", "n2", "at").select("n1", "n2", "piece")
    return dealt.mapInArrow(_hashed_lists, "n1 long, n2 long, ends_sha256 string")


def trie(sequences: DataFrame, ids: DataFrame) -> DataFrame:
    """The trie of sequences (conv_id, pos from 0, digest, words); ``ids`` lists all conversations.

    Per node: conv_id (its smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. The node's texts are the first ``depth`` turns of
    that conversation. No conversations, no rows; without any turn the root alone.
    """
    blocks = stored(_blocks(sequences), "trie-blocks")
    place = ["block", "c1", "c2"]
    edges = blocks.groupBy(*place).agg(
        F.count("*").alias("n"), F.min(F.struct("conv_id", "digests", "words", "p1", "p2")).alias("least")
    ).select(*place, "n", F.col("least.conv_id").alias("m"), "least.digests", "least.words", "least.p1", "least.p2")
    edges = stored(edges, "trie-edges")
    single = edges.groupBy("block", "p1", "p2").agg(
        F.count("*").alias("siblings"), F.min("c1").alias("c1"), F.min("c2").alias("c2")
    ).where("siblings = 1").select(*place, F.lit(True).alias("alone"))
    edges = stored(
        edges.join(single, place, "left").withColumn("alone", F.coalesce("alone", F.lit(False))), "trie-siblings"
    )

    nodes = _refined(_turn_nodes(edges), {
        "o1": ("o1", F.min), "o2": ("o2", F.min), "depth": ("depth", F.min), "w": ("turn_words", F.min),
        "n": ("n", F.sum), "m": ("m", F.min),
    })
    nothing = F.lit(None).cast("long")
    zero = F.lit(0).cast("long")
    root = ids.agg(F.count("*").alias("n"), F.min("conv_id").alias("m")).where("n > 0").select(
        zero.alias("n1"), zero.alias("n2"), nothing.alias("o1"), nothing.alias("o2"), zero.alias("depth"), zero.alias("w"), "n", "m",
    )
    nodes = nodes.unionByName(root)
    nodes = stored(nodes, "trie-turn-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("o1").alias("n1"), F.col("o2").alias("n2")).agg(F.count("*").alias("n_children"))
    nodes = stored(
        nodes.join(children, ["n1", "n2"], "left").withColumn("n_children", F.coalesce("n_children", zero)), "trie-nodes"
    )

    # what a conversation owns: words of its nodes, and a leaf at its end
    owned = nodes.groupBy(F.col("m").alias("conv_id")).agg(
        F.sum("w").alias("owned"), F.max(F.when(F.col("n_children") == 0, 1).otherwise(0)).alias("leaf")
    )
    sections = blocks.select("conv_id", "section").distinct().join(owned, "conv_id", "left").fillna(0, ["owned", "leaf"])
    weighed = blocks.select("conv_id", "section", *place, "rest").join(sections, ["conv_id", "section"])
    left = F.least("owned", "rest")
    sums = weighed.groupBy(*place).agg(
        F.sum("rest").alias("rests"), F.sum(left).alias("lefts"), F.sum("leaf").alias("leaves"),
        F.min(F.struct("conv_id", "owned", "rest")).alias("least"),
    ).select(*place, "rests", "lefts", "leaves", F.col("least.owned").alias("m_owned"), F.col("least.rest").alias("m_rest"))
    counted = _refined(_turn_nodes(edges.join(sums, place)), {
        "all_words": ("n * tail + rests", F.sum),
        # of a block's members only the smallest owns nodes inside it
        "own_words": ("lefts - least(m_owned, m_rest) + least(m_owned, tail + m_rest)", F.sum),
        "n_leaves": ("leaves", F.sum),
    })
    saved = counted.select("n1", "n2", (F.col("all_words") - F.col("own_words")).alias("saved_tokens"), "n_leaves")
    whole = nodes.agg(
        F.sum(F.col("w") * (F.col("n") - 1)).alias("saved_tokens"), F.count_if(F.col("n_children") == 0).alias("n_leaves"),
    ).select(zero.alias("n1"), zero.alias("n2"), "saved_tokens", "n_leaves")

    last = blocks.where("last")
    size = F.size("digests")
    ended = last.select("conv_id", _name(1, size).alias("n1"), _name(2, size).alias("n2"))
    silent = ids.join(last.select("conv_id"), "conv_id", "left_anti").select("conv_id", zero.alias("n1"), zero.alias("n2"))

    top = nodes.where("depth = 0").withColumn("parent_conv_id", nothing)
    found = _parents(nodes, nodes.count()).unionByName(top)
    found = found.join(saved.unionByName(whole), ["n1", "n2"]).join(_ends(ended.unionByName(silent)), ["n1", "n2"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return found.select(
        F.col("m").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations (see ``rebuilt`` and ``trie``).

    Rows without conv_id take no part; a null role or text is empty; a repeated row is a turn each time
    it comes. Texts of any length are hashed whole. Further columns are not read.
    """
    return trie(*rebuilt(conversations))
