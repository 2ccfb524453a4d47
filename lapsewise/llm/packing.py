"""Packing pieces of documents into sequences of one capacity.

First-fit decreasing in randomised groups: a hash of each piece's key and of its number in the stored
table picks its group, so pieces that are all alike spread as well; the pieces of a group arrive longest first, and a tournament tree over the free room of the group's open
sequences finds the first one with room in logarithmic time. Pieces stream through a task; what a
task holds is the tree of one group. Groups are independent, so their number follows the number
of pieces and a lost one is packed again with the same result.

A null text counts as empty. Repeated rows are pieces of their own; equal pieces are
interchangeable. A null key is a key like any other. An empty table gives an empty table. A very long
text is many pieces of the capacity, packed like others. Documents' other columns are not carried.
"""

import math
import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapsewise.llm.bpe import Tokenizer
from lapsewise.sources.workspace import materialise

# executors unpickle the helpers below without having this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pieces in a group on average: more leave less padding, fewer spread better.
GROUP_PIECES = 2048


class FirstFit:
    """A tournament tree of free room: each inner node holds the larger room of its two children."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.leaves = capacity, 0, 1
        self.room = [0, 0]

    def place(self, length: int) -> tuple[int, int]:
        """The first sequence with room, and the offset there; a new sequence if none has."""
        room = self.room
        if room[1] < length:
            if self.bins == self.leaves:
                self._double()
                room = self.room
            node = self.leaves + self.bins
            room[node] = self.capacity
            self.bins += 1
        else:
            node = 1
            while node < self.leaves:
                node *= 2
                if room[node] < length:
                    node += 1
        number, offset = node - self.leaves, self.capacity - room[node]
        room[node] -= length
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
        return number, offset

    def _double(self) -> None:
        old, self.leaves = self.room[self.leaves:], 2 * self.leaves
        self.room = [0] * self.leaves + old + [0] * (self.leaves - len(old))
        for node in range(self.leaves - 1, 0, -1):
            self.room[node] = max(self.room[2 * node], self.room[2 * node + 1])


def cut(df: DataFrame, ids: str, capacity: int, *keep: str) -> DataFrame:
    """Pieces of at most ``capacity`` ids: start, length, the ids, and the columns to keep."""
    step = F.lit(capacity)
    n = (F.octet_length(F.col(ids)) / 4).cast("int")
    pieces = F.transform(
        F.sequence(F.lit(0), n - 1, step),
        lambda at: F.struct(
            at.cast("long").alias("start"),
            F.least(step, n - at).cast("long").alias("length"),
            F.substring(F.col(ids), at * 4 + 1, step * 4).alias("ids"),
        ),
    )
    # a filter on the number of ids would be pushed below their encoding, and encode twice
    return df.select(*keep, F.inline(F.when(n > 0, pieces)))


def place(pieces: DataFrame, key: list[str], capacity: int, length: str = "length", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces of 1 to ``capacity`` ids; the pieces are written once."""
    stored = materialise(pieces.withColumn("_number", F.monotonically_increasing_id()), "pieces")
    groups = max(1, math.ceil(stored.count() / group_pieces))
    dealt = stored.withColumn("_group", F.pmod(F.xxhash64(F.lit(17), "_number", *key), F.lit(groups))).drop("_number")
    parts = min(groups, 4 * int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = dealt.repartition(parts, "_group").sortWithinPartitions("_group", F.desc(length), *key)
    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def first_fit(batches):
        group, tree = None, None
        for batch in batches:
            sequence, offset = [], []
            for g, n in zip(batch.column("_group").to_pylist(), batch.column(length).to_pylist()):
                if g != group:
                    group, tree = g, FirstFit(capacity)
                number, at = tree.place(n)
                sequence.append((g << 32) + number)
                offset.append(at)
            columns = [c for c, name in zip(batch.columns, batch.schema.names) if name != "_group"]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=schema.names
            )

    return ordered.mapInArrow(first_fit, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 2) -> DataFrame:
    """Every document's ids and the end id, cut into pieces and packed; the pieces' ids as their CRC."""
    ids = Tokenizer(docs.sparkSession, path).encode(F.col("text"))
    end = F.lit(bytearray(end_id.to_bytes(4, "little")))
    tokens = docs.select("doc_id", F.concat(ids, end).alias("_ids"))
    tokens = tokens.withColumn("doc_tokens", (F.octet_length("_ids") / 4).cast("long"))
    pieces = cut(tokens, "_ids", capacity, "doc_id", "doc_tokens")
    # the ids themselves need not travel to be placed
    light = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return place(light, ["doc_id", "start", "ids_crc32"], capacity)


def sequences(placed: DataFrame, ids: str = "ids") -> DataFrame:
    """One row for each sequence: its ids in order and how many there are. A sequence is one task's row."""
    parts = F.sort_array(F.collect_list(F.struct("offset", F.col(ids).alias("ids"))))
    joined = F.aggregate(parts, F.lit(bytearray()), lambda done, part: F.concat(done, part["ids"]))
    return placed.groupBy("sequence_id").agg(joined.alias("ids"), F.sum("length").alias("length"))
