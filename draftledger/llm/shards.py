"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

Shards stand in racks, racks in regions. A document descends from the root: at each level it draws
for every child the time -ln(u) / weight, u being a hash of document and child, and takes the
child with the shortest; so each child is taken in proportion to its weight. The draws depend on the
document's id and the tree alone, never on other rows.

A node's weight is the sum of its shards'. If it were drawn as one number, a rack that grew would
call documents in that its old shards then receive. Weight that comes later therefore draws
beside the node's own, as an entry of its own (``epoch``), and who is called in by an entry
descends among what came with it. So a shard that is added takes documents only into itself, and
nobody else moves, wherever in the tree it stands. If a shard's weight falls, only documents of
the rack entry, region entry and shard that hold it move: within them, or out of them.

Law: ``key``. The id and the tree decide, so equal texts with different ids are not kept together.
The size of a shard follows its weight up to the chance of the draws and the sizes of the documents.

Slots number a shard's documents from 0 in order of a hash of the id (then id, size, checksum, and place
in the input). The numbers come from one range shuffle by (shard, that order) and from counts by
(shard, partition), so a shard is numbered by many tasks, whatever ids or texts repeat.

Defined results: null text has size 1 and checksum 0; rows with a null id draw alike, so they share a shard;
repeated rows share a shard and have slots of their own; an empty table gives an empty result; texts are
read whole; columns of the input never clash with the working columns.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from draftledger.functions.windows import row_number_within
from draftledger.llm.common import load, materialize, pack, unpack

SHARDS, REGIONS, RACKS = 16, 4, 2


@dataclass(frozen=True)
class Shard:
    """A leaf: where it stands, its weight, and with which change it came."""

    number: int
    region: str
    rack: str
    weight: float = 1.0
    epoch: int = 0


@dataclass(frozen=True)
class Tree:
    shards: tuple[Shard, ...]

    @classmethod
    def even(cls, shards: int = SHARDS, regions: int = REGIONS, racks: int = RACKS) -> Tree:
        """Shards of weight 1, dealt to the regions in turn and there to the racks in turn."""
        return cls(tuple(Shard(i, f"r{i % regions}", f"k{i // regions % racks}") for i in range(shards)))

    @classmethod
    def of(cls, shards: int) -> Tree:
        """The tree of so many shards: ``SHARDS`` of one build, each further one added to the lightest rack."""
        tree = cls.even(min(shards, SHARDS))
        while len(tree.shards) < shards:
            tree = tree.grown()
        return tree

    def grown(self, region: str | None = None, rack: str | None = None, weight: float = 1.0) -> Tree:
        """With one more shard, in the lightest rack unless one is named. It takes rows only into itself."""
        if region is None:
            load_ = defaultdict(float)
            for s in self.shards:
                load_[s.region, s.rack] += s.weight
            region, rack = min(load_, key=lambda k: (load_[k], k))
        number = 1 + max((s.number for s in self.shards), default=-1)
        epoch = 1 + max((s.epoch for s in self.shards), default=-1)
        return Tree((*self.shards, Shard(number, region, rack or "k0", weight, epoch)))

    def weighted(self, number: int, weight: float) -> Tree:
        """With another weight for one shard; more weight comes as an entry of its own, so that it
        takes rows only into the shard; 0 empties it."""
        own = [s for s in self.shards if s.number == number]
        now = sum(s.weight for s in own)
        if weight > now:
            epoch = 1 + max(s.epoch for s in self.shards)
            return Tree((*self.shards, replace(own[0], weight=weight - now, epoch=epoch)))
        share = weight / now if now else 0.0
        return Tree(tuple(replace(s, weight=s.weight * share) if s.number == number else s for s in self.shards))

    def entries(self) -> list[list[tuple[str, float, int]]]:
        """For each inner node its entries (name, weight, what it leads to): the place of a node
        in this list, or for a rack's entries the number of a shard. The root is first."""
        nodes: list[list[tuple[str, float, int]]] = [[]]
        groups = [(nodes[0], [s for s in self.shards if s.weight > 0], "")]
        for level in ("region", "rack"):
            below = []
            for entries, shards, path in groups:
                by = defaultdict(list)
                for s in shards:
                    by[getattr(s, level), s.epoch].append(s)
                for (name, epoch), some in sorted(by.items()):
                    entries.append((f"{path}/{name}#{epoch}", sum(s.weight for s in some), len(nodes)))
                    nodes.append([])
                    below.append((nodes[-1], some, f"{path}/{name}#{epoch}"))
            groups = below
        for entries, shards, path in groups:
            entries += [(f"{path}/{s.number}", s.weight, s.number) for s in sorted(shards, key=lambda s: s.number)]
        return nodes


def _literal(entries: list[tuple[str, float, int]]) -> Column:
    return F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(weight)).alias("weight"), F.lit(to).alias("to"))
                     for name, weight, to in entries])


def _draw(key: Column, entry: Column) -> Column:
    """-ln(u) / weight, u from the upper 53 bits of the hash of key and entry, never 0 or 1."""
    bits = F.shiftrightunsigned(F.xxhash64(key, entry["name"]), 11)
    return -F.log((bits.cast("double") + 0.5) / F.lit(2.0 ** 53)) / entry["weight"]


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard that a string key descends to; null in a tree without weight."""
    nodes = tree.entries()
    if not nodes[0]:
        return F.lit(None).cast("int")
    every = F.array(*[_literal(e) for e in nodes])
    at = F.lit(0)
    for _ in range(3):  # region, rack, shard
        best = F.array_min(F.transform(F.get(every, at), lambda e: F.struct(_draw(key, e).alias("time"), e["to"].alias("to"))))
        at = best["to"]
    return at


def measured(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document as struct ``row`` with its id as text, size (bytes and 1) and checksum."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return pack(docs, id=F.col(f"`{id_col}`").cast("string"), size=(F.octet_length(text) + 1).cast("long"),
                text_crc32=F.crc32(text.cast("binary")))


def assign(docs: DataFrame, tree: Tree, grown: Tree | None = None) -> DataFrame:
    """Measured documents with ``shard`` and, if a grown tree is given, ``grown_shard``."""
    key = F.col("id")
    later = shard_of(key, grown) if grown else F.lit(None).cast("int")
    return docs.withColumns({"shard": shard_of(key, tree), "grown_shard": later})


def numbered(assigned: DataFrame) -> DataFrame:
    """With ``slot``: from 0 without gaps in every shard."""
    order = [F.xxhash64("id").asc(), F.col("id").asc_nulls_last(), F.col("size").asc(), F.col("text_crc32").asc(), F.col("_tie").asc()]
    tied = materialize(assigned.withColumn("_tie", F.monotonically_increasing_id()), "shardrows")
    out = row_number_within(tied, ["shard"], order, "slot")
    return out.withColumn("slot", F.col("slot") - 1).drop("_tie")


def write(docs: DataFrame, folder: str, tree: Tree | None = None, **options) -> DataFrame:
    """The documents in ``folder``/shard=N/, each shard's in order of its slots; read back."""
    placed = numbered(assign(measured(docs, **options), tree or Tree.of(SHARDS)))
    rows = unpack(placed, "shard", "slot")
    rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def query(spark, sf_dir: str) -> DataFrame:
    docs = measured(load(spark, sf_dir, "documents").select("doc_id", "text"))
    lean = docs.select(F.struct("row.doc_id").alias("row"), "id", "size", "text_crc32")  # the text is measured only
    placed = numbered(assign(lean, Tree.of(SHARDS), Tree.of(SHARDS + 1)))
    return placed.select("row.doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
