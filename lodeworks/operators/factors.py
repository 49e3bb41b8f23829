"""Alternating least squares from partially aggregated normal equations, for a whole grid of settings at once.

A half-step needs, for every item, the sum over its ratings of the outer product of the
user's factors with themselves (a Gram matrix, packed as its lower half), and of the
factors times the rating. Ratings are dealt once for each side into blocks of bounded
size, a block a row: the ratings of an item share a block, but an item with many is
split over several. The task that solves a block sends its factors on as one matrix for
each block of the other side, with the rows that occur there and no others; which rows
those are is worked out once, when the blocks are made. So a half-step is one shuffle of
a few wide rows, without a join, and half-steps follow one another as the stages of one
job. Sums of ids that are split are shuffled to one block, which adds them up, solves
them and sends the factors. An item with a third of all ratings is a small row per
block, and no task ever holds an item's ratings.

Where that would be much, and the ids of one side are few, all of these count as split,
and their ratings lie in the blocks of the other side: each factor of the many is sent
once, and the sums of the few in ``phases``, so that disk holds a part of them at a
time. Half-steps are then stored one by one, and what the one before left is removed.

Settings share the passes: the factors of all ranks and regularisations of a grid stand
beside each other in one row, a pass over the ratings serves them all, and numbers of
iterations are stages of one run. A grid of 27 settings with up to 20 iterations takes
40 passes, not 27 fits.

The regularisation of a row of factors is ``reg`` times its number of ratings, as usual.
Starting factors are hashes of the id and the seed, so results depend on the ratings and
the seed alone, up to the order in which sums are rounded. Rows with a null id or rating,
or a rating that is not finite, take no part; pairs that repeat each count. Pairs whose
user or item has no rating in training have no prediction.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import ExitStack
from dataclasses import dataclass
from functools import reduce
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lodeworks.operators.evaluation import mark_best
from lodeworks.operators.recommend import GRID_SCHEMA, SETTINGS
from lodeworks.sources.readers import rows_to_df
from lodeworks.sources.scratch import materialize, remove, setting, step, swept
from lodeworks.sources.workers import importable

HELD = 1 << 24  # numbers of factors that a block holds, about
RATED = 1 << 21  # ratings that a block holds, about
SPLIT = 4  # an id with more than this part of a block is split over blocks
ROWS = 1 << 22  # numbers of products that are made at a time
SENT = 1 << 20  # numbers of factors in a row that is sent
CHAINED = 8  # half-steps that are stages of one job
LARGE = 1 << 27  # numbers that are shuffled at a time, about; ratings with more factors are dealt by ``planned``


@dataclass(frozen=True)
class Layout:
    """Where the factors and sums of each (rank, regularisation) stand in a row."""

    settings: tuple[tuple[int, float], ...]

    @property
    def width(self) -> int:
        return sum(rank for rank, _ in self.settings)

    def places(self) -> Iterator[tuple[int, float, slice]]:
        at = 0
        for rank, reg in self.settings:
            yield rank, reg, slice(at, at + rank)
            at += rank

    def sums(self, factors: np.ndarray, ratings: np.ndarray) -> np.ndarray:
        """Rows of ids with equally many ratings (``id, rating, factor``): per setting the packed Gram matrix, then the
        factors times the ratings; last their number."""
        parts = []
        for rank, _, where in self.places():
            own = factors[:, :, where]
            turned = own.transpose(0, 2, 1)
            i, j = np.tril_indices(rank)
            parts += [(turned @ own)[:, i, j], (turned @ ratings[:, :, None])[:, :, 0]]
        return np.concatenate([*parts, np.full((len(ratings), 1), ratings.shape[1])], axis=1)

    @property
    def sum_width(self) -> int:
        return sum(rank * (rank + 1) // 2 + rank for rank, _ in self.settings) + 1

    def solved(self, sums: np.ndarray) -> np.ndarray:
        """The factors that the summed equations give, a row for each row of ``sums``."""
        parts, at = [], 0
        for rank, reg, _ in self.places():
            i, j = np.tril_indices(rank)
            gram = np.zeros((len(sums), rank, rank))
            gram[:, i, j] = gram[:, j, i] = sums[:, at:at + len(i)]
            gram[:, np.arange(rank), np.arange(rank)] += reg * sums[:, -1:]
            at += len(i)
            parts.append(np.linalg.solve(gram, sums[:, at:at + rank, None])[:, :, 0])
            at += rank
        return np.concatenate(parts, axis=1)


def _wide(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as lists."""
    places = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32) if values.size else np.zeros(len(values) + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(values.ravel()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _filled(schema: pa.Schema, n: int, **columns: object) -> pa.RecordBatch:
    """``n`` rows with these columns (arrays or lists), the others null."""
    return pa.RecordBatch.from_arrays([
        found if isinstance(found := columns.get(c.name, pa.nulls(n, c.type)), pa.Array) else pa.array(found, c.type)
        for c in schema], schema=schema)


def _listed(values: pa.Array, kind: pa.DataType) -> pa.Array:
    """One row with all values as its list."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values.cast(kind.value_type))


def _numbers(row: dict, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(row[column].as_buffer(), kind)


def _rows(batch: pa.RecordBatch) -> list[dict]:
    return [{name: batch.column(name)[i] for name in batch.schema.names} for i in range(batch.num_rows)]


def _met(batches: Iterator[pa.RecordBatch], own: str) -> tuple[list[dict], list[pa.RecordBatch]]:
    """The rows of a partition that have the column ``own``, by name, and the batches of the others."""
    rows, others = [], []
    for batch in batches:
        mine = batch.column(own).is_valid()
        if mine.true_count:
            rows += _rows(batch.filter(mine))
        if mine.true_count < batch.num_rows:
            others.append(batch.filter(pc.invert(mine)))
    return rows, others


@dataclass(frozen=True)
class Side:
    """One side (``of``) in blocks, and whether any of its ids is split.

    A row of ``blocks`` is a source of factors: below ``n_blocks`` a block with its ratings (``ids``; ``own``, the source
    that solves each; ``ends`` of their ratings; ``places`` of the ratings' factors in what the block is sent; ``ratings``),
    beyond it split ids that are solved together (``ids``), ``phases`` such sources for each block. The source sends block
    ``to[i]`` of the other side the factors of ``mine``, up to ``to_ends[i]``. The split ids are solved in as many
    ``phases``, none if no id is split; a ``large`` side's half-steps are stored one by one.
    """

    of: str
    other: str
    blocks: DataFrame
    n_blocks: int
    phases: int
    large: bool


def planned(ratings: DataFrame, n: int, layout: Layout) -> tuple[int, str | None, int]:
    """The number of blocks, the side of which all ids are split, if any, and in how many phases these are solved.

    A block of its own ratings is sent the factors that occur there, so each id's factors go to nearly as many blocks as it
    has ratings. Where the ids of one side are few and have many ratings, less is sent if the blocks are those of the
    other side: these have the other's factors already, and send the sums of the few, at most one of each id and block.
    """
    n_blocks = max(ratings.sparkSession.sparkContext.defaultParallelism, -(-n // RATED))
    apart = max(n_blocks, -(-n * layout.width // HELD))
    if n * layout.width <= LARGE:
        return apart, None, 1
    users, items = ratings.agg(F.approx_count_distinct("user"), F.approx_count_distinct("item")).first()
    of, few, many = ("item", items, users) if items <= users else ("user", users, items)
    n_blocks = max(n_blocks, -(-many * layout.width // HELD))
    if min(few, n // n_blocks) * layout.width > 2 * HELD:
        n_blocks = apart
    sums = min(n, few * n_blocks) * layout.sum_width
    if sums + (many + min(n, few * n_blocks)) * layout.width >= sum(min(n, k * apart) for k in (few, many)) * layout.width:
        return apart, None, 1
    return n_blocks, of, -(-sums // LARGE)


def dealt(ratings: DataFrame, layout: Layout) -> tuple[Side, Side]:
    """The users and the items of ``ratings`` (``user, item, rating``, stored) in blocks, a task each or more of bounded size."""
    n = ratings.count()
    n_blocks, gathered, phases = planned(ratings, n, layout)
    share = max(1, int(n / (SPLIT * n_blocks)))
    placed, homes = ratings.withColumn("_row", F.monotonically_increasing_id()), {}
    others = {"user": "item", "item": "user"}
    for of in (others[gathered], gathered) if gathered else others:
        if of == gathered:
            home = (F.pmod(F.xxhash64(of, F.lit(0).cast("bigint")), F.lit(n_blocks * phases)) + n_blocks).cast("int")
            homes[of] = ratings.select(of).distinct().select(home.alias("src"), F.col(of).alias("id"))
            placed = placed.withColumns({f"{of}_block": F.col(f"{others[of]}_block"), f"{of}_src": home})
            continue
        home = F.pmod(F.xxhash64(of, F.lit(0).cast("bigint")), F.lit(n_blocks)).cast("int")
        large = materialize(ratings.groupBy(of).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > share).select(
            of, "n", (home + n_blocks).alias("src")), "split-ids")
        if large.isEmpty():
            placed = placed.withColumns({f"{of}_block": home, f"{of}_src": home})
            continue
        homes[of] = large.select("src", F.col(of).alias("id"))
        part = F.coalesce(F.pmod("_row", F.ceil(F.col("_n") / share)), F.lit(0).cast("bigint"))
        block = F.pmod(F.xxhash64(of, part), F.lit(n_blocks)).cast("int")
        placed = placed.join(large.select(F.col(of).alias("_id"), F.col("n").alias("_n"), F.col("src").alias("_src")),
                             F.col(of) == F.col("_id"), "left").withColumns(
            {f"{of}_block": block, f"{of}_src": F.coalesce("_src", block)}).drop("_id", "_n", "_src")
    kept = {of: materialize(_blocks(placed, of, other, n_blocks), f"{of}-ratings") for of, other in others.items()}

    def side(of: str, other: str) -> Side:
        own = kept[of].where("ids is not null").withColumn("src", F.col("block")).drop("block", "wanted")
        solved_in = (phases if of == gathered else 1) if of in homes else 0
        if solved_in:
            together = homes[of].groupBy("src").agg(F.collect_list("id").alias("ids"))
            own = own.unionByName(together, allowMissingColumns=True)
        wanted = kept[other].where("wanted is not null").select("src", "block", "wanted")
        linked = _linked(own.unionByName(wanted, allowMissingColumns=True), n_blocks * (1 + solved_in))
        return Side(of, other, materialize(linked, f"{of}-blocks"), n_blocks, solved_in, n * layout.width > LARGE)

    sides = side("user", "item"), side("item", "user")
    remove(*kept.values())
    return sides


def _blocks(placed: DataFrame, of: str, other: str, n_blocks: int) -> DataFrame:
    """A row for each block with its ratings, and one for each source with the ids whose factors the block wants from it."""
    rows = placed.select(F.col(f"{of}_block").alias("block"), F.col(of).alias("id"), F.col(f"{of}_src").alias("own"),
                         F.col(other).alias("other"), F.col(f"{other}_src").alias("src"), "rating")
    kinds = {c: placed.schema[c].dataType for c in (of, other)}
    lists = {c: pa.list_(to_arrow_type(kind)) for c, kind in kinds.items()}
    schema = pa.schema([("block", pa.int32()), ("ids", lists[of]), ("own", pa.binary()), ("ends", pa.binary()), ("places", pa.binary()),
                        ("ratings", pa.binary()), ("src", pa.int32()), ("wanted", lists[other])])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The partition is one block."""
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        table = pa.Table.from_batches(batches)
        number = table.column("block")[0].as_py()
        ids, others = (table.column(c).combine_chunks().dictionary_encode() for c in ("id", "other"))
        codes, other_codes = ids.indices.to_numpy(), others.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        ends = np.cumsum(np.bincount(codes))
        first = order[np.append(0, ends[:-1])]
        sources = np.empty(len(others.dictionary), np.int32)
        sources[other_codes] = table.column("src").to_numpy()
        by_source = np.argsort(sources, kind="stable")  # the order of what the block is sent
        places = np.empty(len(sources), np.int32)
        places[by_source] = np.arange(len(sources), dtype=np.int32)
        yield _filled(schema, 1, block=[number], ids=_listed(ids.dictionary, lists[of]), own=[table.column("own").to_numpy()[first].astype("<i4").tobytes()],
                      ends=[ends.astype("<i8").tobytes()], places=[places[other_codes[order]].astype("<i4").tobytes()],
                      ratings=[table.column("rating").to_numpy()[order].astype("<f8").tobytes()])
        found, at = np.unique(sources[by_source], return_index=True)
        for source, some in zip(found.tolist(), np.split(by_source, at[1:]), strict=True):
            yield _filled(schema, 1, block=[number], src=[source], wanted=_listed(others.dictionary.take(pa.array(some)), lists[other]))

    return rows.repartitionById(n_blocks, "block").mapInArrow(packed, (
        f"block int, ids array<{kinds[of].simpleString()}>, own binary, ends binary, places binary, ratings binary, "
        f"src int, wanted array<{kinds[other].simpleString()}>"))


def _linked(rows: DataFrame, n_sources: int) -> DataFrame:
    """Sources (with ``ids``) with the places of the ids that each block wants (``src, block, wanted``)."""
    passed = ["own", "ends", "places", "ratings"]
    kind = rows.schema["ids"].dataType
    listed = pa.list_(to_arrow_type(kind.elementType))
    schema = pa.schema([("src", pa.int32()), ("ids", listed), *[(c, pa.binary()) for c in (*passed, "to", "to_ends", "mine")]])

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The partition is one source."""
        found, others = _met(batches, "ids")
        if not found:
            return
        (row,) = found
        ids, to, mine = row["ids"].values, [], [np.zeros(0, np.int32)]
        for batch in others:
            to += batch.column("block").to_pylist()
            mine += [pc.index_in(wanted.values, value_set=ids).to_numpy() for wanted in batch.column("wanted")]
        yield _filled(schema, 1, src=[row["src"].as_py()], ids=_listed(ids, listed), **{c: [row[c].as_py()] for c in passed},
                      to=[np.array(to, "<i4").tobytes()], to_ends=[np.cumsum([len(m) for m in mine[1:]], dtype="<i8").tobytes()],
                      mine=[np.concatenate(mine).astype("<i4").tobytes()])

    return rows.repartitionById(n_sources, "src").mapInArrow(links, (
        f"src int, ids {kind.simpleString()}, {', '.join(f'{c} binary' for c in schema.names[2:])}"))


@dataclass(frozen=True)
class Post:
    """What a source of one side gives: its factors, cut up for the blocks of the other side, or by id.

    A row with a ``block`` is for that block, ``at`` the place of its first factor among those of the source; beyond ``n_blocks`` it has sums for a source that solves split ids (``ids``).
    A row without has the factors of the source's ``ids``.
    """

    layout: Layout
    ids: pa.DataType

    @property
    def schema(self) -> pa.Schema:
        return pa.schema([("block", pa.int32()), ("src", pa.int32()), ("at", pa.int32()), ("ids", self.ids), ("f", pa.binary())])

    def sent(self, row: dict, found: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The source's factors as the blocks of the other side want them."""
        to, ends, mine = (_numbers(row, c, t) for c, t in (("to", "<i4"), ("to_ends", "<i8"), ("mine", "<i4")))
        some, rows, n = max(1, SENT // self.layout.width), [], 0

        def batch() -> pa.RecordBatch:
            blocks, places, parts = zip(*rows, strict=True)
            return _filled(self.schema, len(rows), block=list(blocks), src=[row["src"].as_py()] * len(rows), at=list(places), f=list(parts))

        for block, start, end in zip(to.tolist(), [0, *ends.tolist()], ends.tolist(), strict=False):
            for at in range(start, end, some):
                own = mine[at:min(end, at + some)]
                rows.append((block, at - start, found[own].tobytes()))
                n += len(own)
                if n >= some:
                    yield batch()
                    rows, n = [], 0
        if rows:
            yield batch()

    def kept(self, row: dict, found: np.ndarray, ids: pa.Array) -> Iterator[pa.RecordBatch]:
        """The source's factors by id."""
        some = max(1, SENT // self.layout.width)
        for at in range(0, len(ids), some):
            yield _filled(self.schema, 1, src=[row["src"].as_py()], ids=_listed(ids[at:at + some], self.ids), f=[found[at:at + some].tobytes()])


def _posted(side: Side, layout: Layout) -> tuple[Post, str]:
    kind = side.blocks.schema["ids"].dataType
    return Post(layout, pa.list_(to_arrow_type(kind.elementType))), f"block int, src int, at int, ids {kind.simpleString()}, f binary"


def first_sent(side: Side, layout: Layout, seed: int) -> DataFrame:
    """The starting factors of one side, as the other side's blocks want them."""
    post, kind = _posted(side, layout)
    started = side.blocks.select("src", "to", "to_ends", "mine", F.transform("ids", lambda x: x.cast("string")).alias("texts"))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _rows(batch):
                yield from post.sent(row, _started_rows(row["texts"].values, layout, seed))

    return started.mapInArrow(send, kind)


def _started_rows(texts: pa.Array, layout: Layout, seed: int) -> np.ndarray:
    """What ``_started`` gives for ids with these texts, in the memory of their numbers."""
    ends = [f":{place}:{seed}".encode() for place in range(layout.width)]
    found = np.empty((len(texts), layout.width))
    for at in range(0, len(texts), 1024):
        own = [text.encode() for text in texts[at:at + 1024].to_pylist()]
        hashed = b"".join([md5(text + end, usedforsecurity=False).digest()[:4] for text in own for end in ends])
        found[at:at + 1024] = np.frombuffer(hashed, ">u4").reshape(-1, layout.width) / 2.0**32
    for rank, _, where in layout.places():
        found[:, where] /= float(rank) ** 0.5
    return found


def _solved(side: Side, sent: DataFrame, layout: Layout, keep: bool, phase: int) -> DataFrame:
    """The rows of ``Post`` that the sources of one phase give, from what the blocks are ``sent``."""
    post, kind = _posted(side, layout)
    n_blocks, split, phases = side.n_blocks, side.phases > 0, max(1, side.phases)
    blocks = side.blocks.where(F.col("src") < n_blocks).withColumn("block", F.col("src"))
    if split:
        blocks = blocks.drop("to", "to_ends", "mine")  # the homes send
    elif not keep:
        blocks = blocks.drop("ids")
    met = blocks.unionByName(sent.select("block", "src", "at", "f"), allowMissingColumns=True).repartitionById(n_blocks, "block")

    def solve_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The partition is one block: a row of its ratings, and the factors that it wants."""
        found, others = _met(batches, "ends")
        if not found:
            return
        (row,) = found
        parts = sorted(((r["src"].as_py(), r["at"].as_py(), r["f"]) for batch in others for r in _rows(batch)), key=lambda part: part[:2])
        factors = np.concatenate([np.frombuffer(f.as_buffer()) for *_, f in parts]).reshape(-1, layout.width)
        del parts, others
        ends, place, ratings, own = (_numbers(row, c, t) for c, t in (
            ("ends", "<i8"), ("places", "<i4"), ("ratings", "<f8"), ("own", "<i4")))
        starts = np.append(0, ends)
        counts = np.diff(starts)
        here = (own < n_blocks) if phase == 0 else np.zeros(len(own), bool)
        found = np.zeros((len(counts) if here.any() else 0, layout.width))
        now = np.flatnonzero(here | ((own >= n_blocks) & ((own - n_blocks) % phases == phase)))
        by_count = now[np.argsort(counts[now], kind="stable")]
        sizes, at = np.unique(counts[by_count], return_index=True)
        for n, alike in zip(sizes.tolist(), np.split(by_count, at[1:]), strict=True):
            wide = max(1, ROWS // layout.width)  # ratings at a time
            some = max(1, ROWS // max(n * layout.width, layout.sum_width))  # ids at a time
            for those in (alike[c:c + some] for c in range(0, len(alike), some)):
                sums = np.zeros((len(those), layout.sum_width))
                for c in range(0, n, wide):
                    rows = starts[those][:, None] + np.arange(c, min(n, c + wide))
                    sums += layout.sums(factors[place[rows]], ratings[rows])
                whole = here[those]
                if whole.any():
                    found[those[whole]] = layout.solved(sums[whole])
                for home in np.unique(own[those[~whole]]).tolist():
                    there = own[those] == home
                    yield _filled(post.schema, 1, block=[home], src=[row["src"].as_py()], f=[sums[there].tobytes()],
                                  ids=_listed(row["ids"].values.take(pa.array(those[there])), post.ids))
        if split:
            if len(found):
                yield _filled(post.schema, 1, block=[row["src"].as_py()], src=[row["src"].as_py()], f=[found.tobytes()])
            return
        yield from post.sent(row, found)
        if keep:
            yield from post.kept(row, found, row["ids"].values)

    def solve_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The partition is a source of split ids with the sums of their parts, and a block with the factors it solved."""
        sources, others = _met(batches, "to")
        given = sorted((r for batch in others for r in _rows(batch)), key=lambda r: r["src"].as_py())
        for row in sources:
            number, ids = row["src"].as_py(), row["ids"].values
            mine = [r for r in given if r["block"].as_py() == number]
            if number < n_blocks:
                whole = _numbers(row, "own", "<i4") < n_blocks
                found = np.concatenate([np.zeros(0), *[_numbers(r, "f", "<f8") for r in mine]]).reshape(-1, layout.width)
                yield from post.sent(row, found)
                if keep and whole.any():
                    yield from post.kept(row, found[whole], ids.filter(pa.array(whole)))
                continue
            sums = np.zeros((len(ids), layout.sum_width))
            for r in mine:  # an id occurs once in each block
                sums[pc.index_in(r["ids"].values, value_set=ids).to_numpy()] += _numbers(r, "f", "<f8").reshape(-1, layout.sum_width)
            found = layout.solved(sums)
            yield from post.sent(row, found)
            if keep:
                yield from post.kept(row, found, ids)

    solved = met.mapInArrow(solve_block, kind)
    if not split:
        return solved
    sources = side.blocks.select("src", "ids", "own", "to", "to_ends", "mine", F.col("src").alias("block"))
    own = (F.col("src") - n_blocks) % phases == phase
    together = sources.where(own & (F.col("src") >= n_blocks) | (F.col("src") < n_blocks) if phase == 0 else own & (F.col("src") >= n_blocks))
    at = F.when(F.col("block") < n_blocks, F.col("block")).otherwise(F.floor((F.col("block") - n_blocks) / phases)).cast("int")
    return together.unionByName(solved, allowMissingColumns=True).repartitionById(n_blocks, at).mapInArrow(solve_home, kind)


def half_step(side: Side, sent: DataFrame, layout: Layout, keep: bool,
              store: Callable[[DataFrame, str], DataFrame] = materialize) -> tuple[DataFrame, DataFrame | None]:
    """From what its blocks are ``sent``: what the other side's are, and with ``keep`` the factors ``of, f``, both stored."""
    phases = [_solved(side, sent, layout, keep, phase) for phase in range(max(1, side.phases))]
    if keep or len(phases) > 1:
        phases = [store(solved, f"{side.of}-factors") for solved in phases]
    solved = reduce(DataFrame.unionByName, phases)
    if not keep:
        return solved, None
    return solved.where("block is not null"), materialize(_by_id(solved.where("block is null"), layout, side.of), f"{side.of}-factors")


def _by_id(kept: DataFrame, layout: Layout, of: str) -> DataFrame:
    """``of, f`` from rows of many ids."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, f in zip(batch.column("ids"), batch.column("f"), strict=True):
                yield pa.RecordBatch.from_arrays([ids.values, _wide(np.frombuffer(f.as_buffer()).reshape(-1, layout.width))], names=[of, "f"])

    return kept.mapInArrow(rows, f"{of} {kept.schema['ids'].dataType.elementType.simpleString()}, f array<double>")


def _started(key: Column, layout: Layout, seed: int) -> list[Column]:
    """Numbers from 0 to 1 over the root of the rank, by hashing the id, the place in the row and the seed."""
    def number(place: int, rank: int) -> Column:
        text = F.concat_ws(":", key.cast("string"), F.lit(str(place)), F.lit(str(seed)))
        return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(2.0**32) / F.lit(float(rank) ** 0.5)

    return [number(i, rank) for rank, _, where in layout.places() for i in range(where.start, where.stop)]


def start(ratings: DataFrame, side: str, layout: Layout, seed: int) -> DataFrame:
    """``side, f``: the starting factors of all ids of a side."""
    return ratings.select(side).distinct().select(side, F.array(*_started(F.col(side), layout, seed)).alias("f"))


def usable(df: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """``user, item, rating`` of the rows that have them."""
    value = F.col(rating).cast("double")
    return df.select(F.col(user).alias("user"), F.col(item).alias("item"), value.alias("rating")).where(
        F.col("user").isNotNull() & F.col("item").isNotNull() & (F.abs("rating") < float("inf")))


def run(ratings: DataFrame, layout: Layout, iterations: Sequence[int], seed: int) -> Iterator[tuple[int, DataFrame, DataFrame]]:
    """The factors of users and items after each of the given numbers of iterations, in ascending order."""
    importable(ratings.sparkSession)
    with step(ratings, "ratings") as rated:
        by_user, by_item = dealt(rated, layout)
    sent, chained = first_sent(by_user, layout, seed), 0
    stored: list[DataFrame] = []

    def store(df: DataFrame, name: str) -> DataFrame:
        with setting(df.sparkSession, "spark.sql.parquet.columnarReaderBatchSize", "1"):  # rows of megabytes
            stored.append(materialize(df, name))
        return stored[-1]

    if by_user.large:
        sent = store(sent, "user-factors")
    for done in range(1, max(iterations) + 1):
        found = {}
        for side in (by_item, by_user):
            before = len(stored)
            sent, found[side.of] = half_step(side, sent, layout, done in iterations, store)
            chained += 1
            if len(stored) == before and (side.large or chained == CHAINED):
                sent = store(sent, f"{side.of}-factors")
            if len(stored) > before:  # ``sent`` no longer needs what was stored before
                remove(*stored[:before])
                del stored[:before]
                chained = 0
        if done in iterations:
            yield done, found["user"], found["item"]
    remove(*stored, by_user.blocks, by_item.blocks)


def errors(pairs: DataFrame, users: DataFrame, items: DataFrame, layout: Layout) -> list[float | None]:
    """Root of the mean squared error of each setting over the pairs (stored) that have a prediction."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(len(layout.settings)), 0
        for batch in batches:
            products = _matrix(batch.column("uf"), layout.width) * _matrix(batch.column("vf"), layout.width)
            wrong = [products[:, where].sum(axis=1) - batch.column("rating").to_numpy() for _, _, where in layout.places()]
            total, n = total + np.array([(w**2).sum() for w in wrong]), n + batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), _wide(total[None])], names=["n", "squares"])

    sums = [F.sum(F.element_at("squares", i + 1)) for i in range(len(layout.settings))]
    parts = max(1, -(-pairs.count() * layout.width // LARGE))  # the users' pairs that meet their factors at a time
    kind = users.schema["user"].dataType
    total = np.zeros(1 + len(layout.settings))
    for part in range(parts):
        def now(user: Column) -> Column:
            return F.pmod(F.xxhash64(user, F.lit(1)), F.lit(parts)) == part  # noqa: B023

        some, known = (pairs, users) if parts == 1 else (pairs.where(now(F.col("user").try_cast(kind))), users.where(now(F.col("user"))))
        met = some.join(known.select(F.col("user").alias("_u"), F.col("f").alias("uf")), F.col("user") == F.col("_u")).join(
            items.select(F.col("item").alias("_i"), F.col("f").alias("vf")), F.col("item") == F.col("_i")).select("rating", "uf", "vf")
        total += [x or 0 for x in met.mapInArrow(partial, "n bigint, squares array<double>").agg(F.sum("n"), *sums).first()]
    return [float((s / total[0]) ** 0.5) if total[0] else None for s in total[1:]]


def tune(train: DataFrame, validation: DataFrame, test: DataFrame | None = None, ranks: Sequence[int] = (4, 8, 12),
         regs: Sequence[float] = (0.01, 0.05, 0.1), iterations: Sequence[int] = (10, 15, 20), seed: int = 37,
         user: str = "UserID", item: str = "ItemID", rating: str = "Rating") -> DataFrame:
    """``rank, reg, iters, val_rmse`` of every setting; with ``test`` rows also ``is_best`` and ``test_rmse`` of the best."""
    if min(regs) <= 0:
        raise ValueError("the equations need a positive regularisation")
    layout = Layout(tuple((k, r) for k in ranks for r in regs))
    rows: list[tuple] = []
    tested: tuple[DataFrame, ...] = ()  # factors after the iterations of the best setting so far
    with ExitStack() as last:
        last.enter_context(swept(train.sparkSession))
        held_out = last.enter_context(step(usable(validation, user, item, rating), "validation"))
        finished = last.enter_context(step(usable(test, user, item, rating), "test")) if test is not None else None
        for iters, *found in run(usable(train, user, item, rating), layout, iterations, seed):
            rows += [(k, r, iters, e) for (k, r), e in zip(layout.settings, errors(held_out, *found, layout), strict=True)]
            scores = [(e, k, r, i) for k, r, i, e in rows if e is not None and e == e]
            if finished is not None and scores and min(scores)[3] == iters:
                found, tested = tested, tuple(found)
            remove(*found)
        grid = rows_to_df(train.sparkSession, rows, GRID_SCHEMA)
        if finished is None:
            return grid
        marked = mark_best(grid, "val_rmse", SETTINGS)
        best = marked.where("is_best").select(*SETTINGS).first()
        error = None
        if best is not None:
            error = errors(finished, *tested, layout)[layout.settings.index((best["rank"], best["reg"]))]
            remove(*tested)
    return marked.withColumn("test_rmse", F.when(F.col("is_best"), F.lit(error).cast("double")))


def predict(pairs: DataFrame, users: DataFrame, items: DataFrame, user: str = "UserID", item: str = "ItemID") -> DataFrame:
    """``pairs`` with their ``prediction``; those without factors on both sides are dropped."""
    sides = [df.select(F.col(name).alias(f"_{name}"), F.col("f").alias(f"_{name}_f")) for df, name in ((users, "user"), (items, "item"))]
    product = F.aggregate(F.zip_with("_user_f", "_item_f", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    return pairs.join(sides[0], F.col(user) == F.col("_user")).join(sides[1], F.col(item) == F.col("_item")).select(
        *pairs.columns, product.alias("prediction"))


def fit(ratings: DataFrame, rank: int = 4, reg: float = 0.1, iters: int = 10, seed: int = 37, user: str = "UserID",
        item: str = "ItemID", rating: str = "Rating") -> tuple[DataFrame, DataFrame]:
    """Factors of one setting: ``user, f`` and ``item, f``."""
    if reg <= 0:
        raise ValueError("the equations need a positive regularisation")
    with swept(ratings.sparkSession):
        ((_, users, items),) = run(usable(ratings, user, item, rating), Layout(((rank, reg),)), [iters], seed)
    return users, items
