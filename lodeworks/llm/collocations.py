"""Phrases whose words occur together more often than their parts suggest, with exact counts.

Texts become shards: rows of word numbers of about ``SHARD`` bytes of text, 0 between
pieces, with the shard's own words beside them. The words of all shards are merged by
segments of their hash, which counts them and numbers the frequent ones. Then the phrases grow by a word at a time: a phrase of k
words is the pair of the frequent phrases of k - 1 words it starts and ends with, packed
into one whole number, so that no phrase is counted whose parts are too rare. Each shard
counts its pairs in a counting quotient filter (``quotient.py``) cut into segments by the
highest bits; segments of all shards are merged, which gives exact counts of all shards.
What is frequent gets its number there, and goes back to the shards that hold it, as the
words of the next round.

Shards are stored in buckets: only answers are shuffled to them, their texts stay where
they are. Nothing is broadcast or gathered but one row of totals a round. Shards, segments and the
answers to a shard are bounded by the size of a shard or of a segment (segments grow in
number with the words), whatever phrase, source or language is common.

Defined results: a null text has no words and a null language is ``und``; equal rows each
count; the language of a phrase is that of its rows, compared as it stands; no words make
no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodeworks.llm import quotient
from lodeworks.llm.arrays import gather, map_arrow, row_starts, slices
from lodeworks.llm.buckets import Buckets
from lodeworks.sources.scratch import materialize

SHARD = 8 << 20  # bytes of text after which a shard ends
SEGMENT = 1 << 19  # words of the corpus to a segment of the filters
LEAST_DIGIT = 8  # bits of a segment's number, at least
# What ends a piece, and what separates words inside one.
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, 0x09]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """All words as lower-cased bytes, the row of each, and whether it follows the word before it in one piece."""
    gap = ENDS[data] | BLANKS[data]
    first = row_starts(len(data), offsets)
    before = np.ones(len(data), bool)
    before[1:] = gap[:-1]
    starts = np.flatnonzero(~gap & (before | first))
    after = np.ones(len(data), bool)
    after[:-1] = gap[1:] | first[1:]
    stops = np.flatnonzero(~gap & after) + 1
    piece = np.cumsum(ENDS[data] | first, dtype=np.int64)[starts] if len(starts) else np.zeros(0, np.int64)
    follows = np.zeros(len(starts), bool)
    follows[1:] = piece[1:] == piece[:-1]
    letters, places = gather(LOWER[data], starts, stops)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [
        None, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(letters)])
    return words, np.searchsorted(offsets, starts, "right") - 1, follows


def spaced(codes: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Codes with a 0 before each that does not follow the one before it."""
    return np.insert(codes, np.flatnonzero(~follows), 0)


def squeezed(codes: np.ndarray) -> np.ndarray:
    """One 0 is as good as several."""
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


def _places(coded: pa.DictionaryArray) -> np.ndarray:
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def shards(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``shard, state, langs, words, counts, codes, n``: the text as codes of the shard's own ``n`` words, and these words."""
    source = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, size = TaskContext.get().partitionId(), 0, 0
        known: dict[str, dict[bytes, int]] = {}  # codes of words by language
        parts: list[np.ndarray] = []
        n = 0

        def row() -> pa.RecordBatch:
            nonlocal made, size, known, parts, n
            codes = np.concatenate(parts)
            # By language, not in the order of the codes: the counts follow, and the codes stand beside them.
            own = np.concatenate([np.fromiter(words.values(), np.int64, len(words)) for words in known.values()] or [np.zeros(0, np.int64)])
            counts = np.bincount(codes, minlength=n + 1)[own]
            langs = pa.DictionaryArray.from_arrays(
                np.repeat(np.arange(len(known)), [len(words) for words in known.values()]).astype(np.int32), pa.array(list(known), pa.string()))
            lists = [langs.cast(pa.string()), pa.array([w for words in known.values() for w in words], pa.binary()).cast(pa.string()),
                     pa.array(counts, pa.int64()), pa.array(own)]
            columns = [pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), x) for x in lists]
            row = pa.RecordBatch.from_arrays([
                pa.array([(part << 32) + made]), pa.array([codes.astype("<u4").tobytes()], pa.binary()), *columns,
                pa.array([n], pa.int64())], names=["shard", "state", "langs", "words", "counts", "codes", "n"])
            made, size, known, parts, n = made + 1, 0, {}, [], 0
            return row

        for rows, data, offsets in slices(batches, "text"):
            words, of_row, follows = words_of(data, offsets)
            distinct = words.dictionary_encode()
            langs = rows.column("lang").dictionary_encode()
            n_langs = len(langs.dictionary)
            both = _places(distinct) * n_langs + _places(langs)[of_row]
            used = np.zeros(len(distinct.dictionary) * n_langs, bool)
            used[both] = True
            spelled, named = distinct.dictionary.to_pylist(), langs.dictionary.to_pylist()
            own = np.zeros(len(used), np.uint32)
            for at in np.flatnonzero(used).tolist():
                of_lang, word = known.setdefault(named[at % n_langs], {}), spelled[at // n_langs]
                code = of_lang.get(word)
                if code is None:
                    n += 1
                    code = of_lang[word] = n
                own[at] = code
            parts.append(spaced(own[both], follows))
            size += len(data)
            if size >= SHARD:
                yield row()
        if parts:
            yield row()

    return map_arrow(source, run, "shard bigint, state binary, langs array<string>, words array<string>, counts array<bigint>, "
                     "codes array<bigint>, n bigint")


def pairs_of(state: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where two numbers stand side by side, and the mixed pairs there; a number has ``width`` bits."""
    at = np.flatnonzero((state[:-1] != 0) & (state[1:] != 0))
    packed = (state[at].astype(np.uint64) << np.uint64(width)) | state[at + 1]
    return at, quotient.mix(packed, 2 * width)


def _vocabulary(cut: DataFrame, digit: int, min_count: int) -> DataFrame:
    """The shards' words, merged by segments: one row for each segment and one for each shard in it.

    The former has the frequent words (``langs, words, numbers, counts``) and the number
    of all words of each language (``all_langs, all_counts``), the latter the codes of
    the shard's words that are frequent, and their numbers.
    """
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, langs, words, counts, codes in zip(*batch.columns, strict=True):
                langs, words = langs.values, words.values
                places = np.array([zlib.crc32(w.encode()) & ((1 << digit) - 1) for w in words.to_pylist()], np.int64)
                order = np.argsort(places, kind="stable")
                names, starts = np.unique(places[order], return_index=True)
                bounds = pa.array(np.append(starts, len(order)).astype(np.int32))
                picked = pa.array(order)
                lists = [pa.ListArray.from_arrays(bounds, column) for column in (
                    langs.take(picked), words.take(picked), counts.values.take(picked), codes.values.take(picked))]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.full(len(names), name.as_py(), np.int64)), *lists],
                                                 names=["segment", "shard", "langs", "words", "counts", "codes"])

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, owners, parts = key[0].as_py(), [], []
        for batch in batches:
            owners += batch.column("shard").to_pylist()
            parts += list(zip(*[[x.values for x in batch.column(c)] for c in ("langs", "words", "counts", "codes")], strict=True))
        langs, words = (pa.concat_arrays([p[i] for p in parts]).dictionary_encode() for i in (0, 1))
        counts = np.concatenate([p[2].to_numpy() for p in parts])
        n_langs = len(langs.dictionary)
        distinct, place = np.unique(_places(words) * n_langs + _places(langs), return_inverse=True)
        totals = np.zeros(len(distinct), np.int64)
        np.add.at(totals, place, counts)
        often = totals >= min_count
        numbers = np.zeros(len(distinct), np.int64)
        numbers[often] = np.arange(int(often.sum())) * (1 << digit) + segment + 1
        kept = distinct[often]
        per_lang = np.zeros(n_langs, np.int64)
        np.add.at(per_lang, _places(langs), counts)
        lists = [langs.dictionary.take(pa.array(kept % n_langs)), words.dictionary.take(pa.array(kept // n_langs)),
                 pa.array(numbers[often]), pa.array(totals[often]), langs.dictionary, pa.array(per_lang)]
        nothing = pa.nulls(1, pa.binary())
        yield pa.RecordBatch.from_arrays([
            pa.array([segment], pa.int64()), pa.nulls(1, pa.int64()), nothing, nothing,
            *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]], names=columns)
        ends = np.cumsum([len(p[2]) for p in parts]).tolist()
        for owner, part, a, b in zip(owners, parts, [0, *ends], ends, strict=False):
            own = often[place[a:b]]
            if own.any():
                yield pa.RecordBatch.from_arrays([
                    pa.array([segment], pa.int64()), pa.array([owner], pa.int64()),
                    pa.array([part[3].to_numpy()[own].astype("<u4").tobytes()], pa.binary()),
                    pa.array([numbers[place[a:b][own]].astype("<u4").tobytes()], pa.binary()),
                    *[pa.nulls(1, pa.list_(pa.string() if "string" in kind else pa.int64())) for _, kind in listed]], names=columns)

    listed = [("langs", "array<string>"), ("words", "array<string>"), ("numbers", "array<bigint>"), ("counts", "array<bigint>"),
              ("all_langs", "array<string>"), ("all_counts", "array<bigint>")]
    columns = ["segment", "shard", "codes", "ids", *[c for c, _ in listed]]
    schema = "segment bigint, shard bigint, codes binary, ids binary, " + ", ".join(f"{c} {kind}" for c, kind in listed)
    apart = map_arrow(cut.select("shard", "langs", "words", "counts", "codes"), dealt, "segment bigint, shard bigint, langs array<string>, "
                      "words array<string>, counts array<bigint>, codes array<bigint>")
    return apart.groupBy("segment").applyInArrow(merge, schema)


def _first_state(cut: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``shard, state``: the shards' words by their numbers in the vocabulary, others as gaps."""
    answers = vocabulary.where("shard is not null").groupBy(F.col("shard").alias("of_shard")).agg(
        F.collect_list(F.struct("codes", "ids")).alias("answers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, state, answers in zip(*batch.columns, strict=True):
                state = np.frombuffer(state.as_buffer(), "<u4")
                known, ids = (np.frombuffer(b"".join(answers.values.field(c).to_pylist()), "<u4") for c in ("codes", "ids"))
                table = np.zeros(int(state.max(initial=0)) + 1, np.uint32)
                table[known] = ids
                yield _state(name, table[state])

    joined = cut.select("shard", "state").join(answers, F.col("shard") == F.col("of_shard"))
    return map_arrow(joined.select("shard", "state", "answers"), run, "shard bigint, state binary")


def _state(name: pa.Scalar, state: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([name.as_py()], pa.int64()), pa.array([squeezed(state).astype("<u4").tobytes()], pa.binary())],
                                      names=["shard", "state"])


def _next_state(states: DataFrame, merged: DataFrame, width: int) -> DataFrame:
    """``shard, state``: the frequent phrases of one word more, by their numbers; shards without any are gone."""
    answers = merged.where("shard is not null").groupBy(F.col("shard").alias("of_shard")).agg(
        F.sort_array(F.collect_list(F.struct("segment", "mixed", "ids"))).alias("answers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, state, answers in zip(*batch.columns, strict=True):
                state = np.frombuffer(state.as_buffer(), "<u4")
                listed = answers.values
                known = np.frombuffer(b"".join(listed.field("mixed").to_pylist()), "<u8")  # segments in order are numbers in order
                ids = np.frombuffer(b"".join(listed.field("ids").to_pylist()), "<u4")
                at, mixed = pairs_of(state, width)
                place = np.minimum(np.searchsorted(known, mixed), len(known) - 1)
                new = np.zeros(len(state), np.uint32)
                new[at] = np.where(known[place] == mixed, ids[place], 0)
                yield _state(name, new)

    joined = states.join(answers, F.col("shard") == F.col("of_shard"))
    return map_arrow(joined.select("shard", "state", "answers"), run, "shard bigint, state binary")


def _merged(states: DataFrame, width: int, digit: int, min_count: int) -> DataFrame:
    """Frequent pairs of numbers: one row for each segment (``firsts, lasts, numbers, counts``) and one for each shard in it.

    The latter has the mixed pairs of the shard that are frequent, and their numbers.
    """
    bits = 2 * width
    digit = min(digit, bits)
    low = bits - digit

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, state in zip(*batch.columns, strict=True):
                mixed, counts = quotient.count(pairs_of(np.frombuffer(state.as_buffer(), "<u4"), width)[1])
                segments = (mixed >> np.uint64(low)).astype(np.int64) if low < 64 else np.zeros(len(mixed), np.int64)
                names = np.unique(segments)
                bounds = np.append(np.searchsorted(segments, names), len(mixed)).tolist()
                rest = mixed & np.uint64((1 << low) - 1)
                blobs = [quotient.pack(rest[a:b], counts[a:b], low) for a, b in zip(bounds, bounds[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.full(len(names), name.as_py(), np.int64)),
                                                  pa.array(blobs, pa.binary())], names=["segment", "shard", "filter"])

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, owners, parts = key[0].as_py(), [], []
        for batch in batches:
            owners += batch.column("shard").to_pylist()
            parts += [quotient.unpack(blob.as_buffer()) for blob in batch.column("filter")]
        rest, counts, places = quotient.merge(parts)
        often = counts >= min_count
        numbers = np.zeros(len(rest), np.int64)
        numbers[often] = np.arange(int(often.sum())) * (1 << digit) + segment + 1
        if numbers.max(initial=0) >= 1 << 32:
            raise OverflowError("more frequent phrases than 32 bits number")
        mixed = rest | (np.uint64(segment) << np.uint64(low)) if low < 64 else rest
        packed = quotient.unmix(mixed[often], bits)
        nothing = pa.nulls(1, pa.binary())
        lists = [pa.array([x.astype(np.int64)], pa.list_(pa.int64())) for x in (
            packed >> np.uint64(width), packed & np.uint64((1 << width) - 1), numbers[often], counts[often])]
        yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int64()), pa.nulls(1, pa.int64()), nothing, nothing, *lists],
                                         names=columns)
        ends = np.cumsum([len(m) for m, _ in parts]).tolist()
        for owner, a, b in zip(owners, [0, *ends], ends, strict=False):
            own = places[a:b][often[places[a:b]]]
            if len(own):
                yield pa.RecordBatch.from_arrays([
                    pa.array([segment], pa.int64()), pa.array([owner], pa.int64()),
                    pa.array([mixed[own].astype("<u8").tobytes()], pa.binary()),
                    pa.array([numbers[own].astype("<u4").tobytes()], pa.binary()),
                    *[pa.nulls(1, pa.list_(pa.int64()))] * 4], names=columns)

    columns = ["segment", "shard", "mixed", "ids", "firsts", "lasts", "numbers", "counts"]
    schema = "segment bigint, shard bigint, mixed binary, ids binary, " + ", ".join(f"{c} array<bigint>" for c in columns[4:])
    return map_arrow(states, filters, "segment bigint, shard bigint, filter binary").groupBy("segment").applyInArrow(merge, schema)


def _longer(phrases: DataFrame, merged: DataFrame) -> DataFrame:
    """Phrases of one word more: ``id, lang, phrase, last_word, a, heads, tails, first, last`` (the phrases they start and end with).

    ``heads`` and ``tails`` are the counts of the first 1, 2, ... and of the last 1, 2, ... words.
    """
    pairs = merged.where("shard is null").select(F.inline(F.arrays_zip("firsts", "lasts", "numbers", "counts"))).toDF(
        "first", "last", "id", "a")
    start = phrases.select(F.col("id").alias("first"), "lang", F.col("phrase").alias("start"), F.col("heads").alias("start_heads"))
    end = phrases.select(F.col("id").alias("last"), F.col("last_word"), F.col("tails").alias("end_tails"))
    return pairs.join(start, "first").join(end, "last").select(
        "id", "lang", F.concat_ws(" ", "start", "last_word").alias("phrase"), "last_word", "a",
        F.concat("start_heads", F.array("a")).alias("heads"), F.concat("end_tails", F.array("a")).alias("tails"), "first", "last")


def _scored(phrases: DataFrame, words: int) -> DataFrame:
    """``phrases`` with the cut of the lowest score: ``l, r, score``."""

    def at(cut: int):
        l, r = F.element_at("heads", cut), F.element_at("tails", words - cut)
        exact = [c.cast("decimal(19,0)") for c in (F.col("a"), F.col("n"), l, r)]
        whole = F.call_function("div", F.lit(1000).cast("decimal(4,0)") * exact[0] * exact[1], exact[2] * exact[3])
        return F.struct(whole.alias("score"), F.lit(cut).alias("cut"), l.alias("l"), r.alias("r"))

    return phrases.withColumn("_low", F.array_min(F.array(*[at(k) for k in range(1, words)]))).select(
        "*", "_low.score", "_low.l", "_low.r")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = 5, min_count: int = 100,
                 top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best ``top`` phrases of each language.

    A phrase of 2 to ``max_words`` words counts if it occurs ``a >= min_count`` times.
    Its score is the lowest over its cuts, ``1000 * a * n`` over ``l * r`` rounded down:
    the counts of both parts, ``n`` words in all. Phrases that stand in a longer one of
    equal count are left out.
    """
    if max_words < 2:
        raise ValueError("a phrase has at least two words")
    spark = docs.sparkSession
    with Buckets(spark) as buckets:
        cut = buckets.store(shards(docs, text_col, lang_col), "shards")
        n_entries = cut.agg(F.sum("n")).first()[0] or 0
        digit = max(LEAST_DIGIT, (n_entries // SEGMENT).bit_length())
        vocabulary = materialize(_vocabulary(cut, digit, min_count), "vocabulary")
        merged_words = vocabulary.where("shard is null")
        totals = materialize(merged_words.select(F.inline(F.arrays_zip("all_langs", "all_counts"))).toDF("lang", "n").groupBy(
            "lang").agg(F.sum("n").alias("n")), "words-in-all")
        n_words = totals.agg(F.sum("n")).first()[0] or 0
        level = merged_words.select(F.inline(F.arrays_zip("langs", "words", "numbers", "counts"))).toDF("lang", "phrase", "id", "a").select(
            "id", "lang", "phrase", F.col("phrase").alias("last_word"), "a", F.array("a").alias("heads"), F.array("a").alias("tails"))
        digit = max(LEAST_DIGIT, (n_words // SEGMENT).bit_length())
        state = buckets.store(_first_state(cut, vocabulary), "state")
        found = []
        for words in range(2, max_words + 1):
            largest = level.agg(F.max("id")).first()[0]
            if largest is None:  # nothing to put together
                break
            if largest >= 1 << 32:
                raise OverflowError("more frequent words or phrases than 32 bits number")
            width = int(largest).bit_length()
            merged = materialize(_merged(state, width, digit, min_count), "merged")
            longer = materialize(_longer(level, merged), "phrases")
            found.append((words, longer))
            if words < max_words:
                state = buckets.store(_next_state(state, merged, width), "state")
            level = longer
    scored = []
    for i, (words, phrases) in enumerate(found):
        open_ones = phrases
        if i + 1 < len(found):
            parts = F.explode(F.array(F.struct(F.col("first").alias("part"), F.element_at("heads", words).alias("count")),
                                      F.struct(F.col("last").alias("part"), F.element_at("tails", words).alias("count"))))
            inside = found[i + 1][1].select("a", parts.alias("p")).where(F.col("a") >= F.col("p.count"))
            open_ones = phrases.join(inside.select(F.col("p.part").alias("id")), "id", "left_anti")
        scored.append(_scored(open_ones.join(totals, "lang"), words).select("lang", "phrase", "a", "l", "r", "n", "score"))
    if not scored:
        return totals.where("false").selectExpr("lang", "n as rank", "lang as phrase", "n as a", "n as l", "n as r", "n", "n as score")
    every = scored[0]
    for more in scored[1:]:
        every = every.unionByName(more)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
