"""Phrase collocations by SETM, relational mining of occurrence relations.

Texts are cut into pieces and words.  An occurrence relation holds
(chunk, place, group): the group is a phrase of k words that starts at a place.
Pieces stand apart by an unused place, so that the next place is the next word
of the same piece or nothing.  Relations are stored sorted by place, a row per
chunk with its columns packed:

1. words: each chunk's distinct words are counted once, grouped, and the chunk's
   occurrences are semi-joined with the frequent ones;
2. length k: the relation of the frequent phrases of k - 1 words is merge-joined
   with that of the words by chunk and adjacent place, the pairs are grouped and
   counted, and the occurrences are semi-joined with the frequent pairs before
   the next length extends them.

Counting deals each chunk's distinct groups, sorted and packed, to parts by a
hash of the group; a part adds up what the chunks hold of its groups, and sends
each chunk back the numbers of those that are frequent.  A part's size is that of
all distinct groups over the number of parts, a chunk's is a parameter.  A piece
that crosses a chunk's end goes on into it by as many words as a phrase can reach;
phrases that start there belong to the next chunk.  Groups are numbered, so all
counts are exact.

Defined results: a null language is ``und``; a null, empty or wordless text adds
nothing; repeated rows count as often as they occur; equal scores rank by the
larger count, then by the phrase in UTF-8 byte order; an empty table gives an
empty result.  Only ``lang`` and ``text`` are read, so further columns never
clash.
"""

from __future__ import annotations

import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociframe.llm.common import discard, mix, parts, stored

CHUNK = 1 << 20           # places of a chunk
PARTS = 64, 4096          # least and most parts that groups are dealt to; one a chunk between
ROWS = 1 << 16            # rows of groups in a batch
# Characters that end a piece.
ENDS = b".,;:!?\n\v\f\r"
_TABLE = bytes(255 if c in ENDS else c + 32 if 65 <= c <= 90 else c for c in range(256))
_END = b"\xff"            # no byte of UTF-8

CHUNK_ROW = "chunk long, own int, ids binary, lang string, words binary, counts binary, local binary, n long"
PAIR_ROW = "part int, chunk long, codes binary, counts binary"


def packed(values: np.ndarray) -> bytes:
    """Numbers, compressed byte by byte of all of them: high bytes are alike."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes())


def unpacked(data: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(size, -1).T).view(dtype).ravel()


def steps(place: np.ndarray) -> bytes:
    """Ascending places or codes, packed as steps from one to the next."""
    return packed(np.diff(place, prepend=0).astype("<i8"))


def places(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data, "<i8"), dtype=np.int64)


def _row(schema: pa.Schema, **cells) -> pa.RecordBatch:
    """One row with the given cells, nulls elsewhere."""
    return pa.RecordBatch.from_arrays([pa.array([cells.get(f.name)], f.type) for f in schema], schema=schema)


def _rows(schema: pa.Schema, many: int, **columns):
    """Rows with the given columns (a scalar is repeated), nulls elsewhere."""
    for at in range(0, many, ROWS):
        size = min(ROWS, many - at)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(size, f.type) if f.name not in columns else pa.array(columns[f.name][at:at + size], f.type)
             if not isinstance(columns[f.name], (str, int)) else pa.repeat(pa.scalar(columns[f.name], f.type), size) for f in schema], schema=schema)


def _schema(text: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in text.split(", "))])


def words_of(data: bytes):
    """Lists of words, an ``_END`` where a piece ends."""
    for piece in parts(data):
        yield piece.translate(_TABLE).replace(_END, b" \xff ").split()


def chunks(docs: DataFrame, longest: int) -> DataFrame:
    """For each chunk a row with the word of each place (0: between pieces) and how
    many places are its own, then a row for each language with the chunk's distinct
    words, their counts and numbers, and n, the sum of the counts."""
    schema = _schema(CHUNK_ROW)

    def run(batches):
        from pyspark import TaskContext
        number = (TaskContext.get().partitionId() + 1) << 32
        ahead = longest - 1
        known: dict[str, defaultdict] = {}
        ids: list[int] = []
        new_id = itertools.count(1).__next__

        def table(lang: str) -> defaultdict:
            if lang not in known:
                known[lang] = defaultdict(new_id)
            return known[lang]

        def chunk(own: int):
            """The first ``own`` places as a chunk; what follows starts the next."""
            nonlocal number, ids, known, new_id
            shown = np.array(ids[:own + ahead], "<i4")
            size = int(shown.max(initial=0)) + 1
            counts, used = np.bincount(shown[:own], minlength=size), np.bincount(shown, minlength=size) > 0
            number += 1
            yield _row(schema, chunk=number, own=own, ids=packed(shown))
            for lang, words in known.items():
                listed = [(w, i) for w, i in words.items() if i < size and used[i]]
                if listed:
                    names, local = zip(*listed)
                    n, local = counts[np.array(local)], np.array(local)
                    yield _row(schema, chunk=number, lang=lang, words=joined(names), counts=packed(n.astype("<i4")), local=steps(local), n=int(n.sum()))
            rest = ids[own:]
            back = {i: (lang, w) for lang, words in known.items() for w, i in words.items()} if any(rest) else {}
            known, new_id = {}, itertools.count(1).__next__
            ids = [table(back[i][0])[back[i][1]] if i else 0 for i in rest]

        for b in batches:
            for lang, data in zip(b.column(0).to_pylist(), b.column(1)):
                data = data.as_py()
                for words in words_of(data) if data else ():
                    of = table(lang)
                    of[_END] = 0
                    ids.extend(map(of.__getitem__, words))
                    del of[_END]
                    while len(ids) >= CHUNK + ahead:
                        yield from chunk(CHUNK)
                ids.append(0)
        if any(ids):
            yield from chunk(len(ids))

    narrow = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("text"))
    return narrow.mapInArrow(run, CHUNK_ROW)


DEALT = "part int, chunk long, lang string, words binary, counts binary, local binary"
WORDS = "lang string, phrase string, f long, id long, chunk long, local binary, ids binary"


def joined(words) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"\n".join(words))      # no word holds a line end


def split(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b"\n")


def dealt(cut: DataFrame, parts: int) -> DataFrame:
    """The words of each chunk and language by parts."""
    schema = _schema(DEALT)

    def run(batches):
        for r in _each(batches):
            words, counts, local = split(r["words"]), unpacked(r["counts"], "<i4"), places(r["local"])
            part = np.fromiter(map(xxhash.xxh32_intdigest, words), np.int64, len(words)) % parts
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
            rows = [(i, order[x:y]) for i, (x, y) in enumerate(zip(ends, ends[1:])) if y > x]
            for at in range(0, len(rows), 1024):
                some = rows[at:at + 1024]
                yield from _rows(schema, len(some), part=[i for i, _ in some], chunk=r["chunk"], lang=r["lang"],
                                 words=[joined([words[k] for k in x.tolist()]) for _, x in some],
                                 counts=[packed(counts[x]) for _, x in some], local=[steps(local[x]) for _, x in some])

    return cut.where("words IS NOT NULL").select("chunk", "lang", "words", "counts", "local").mapInArrow(run, DEALT)


def counted_words(rows: DataFrame, least: int, parts: int) -> DataFrame:
    """What the parts find: a row (lang, phrase, f, id) for each frequent word, and
    rows (chunk, local, ids) that tell a chunk which of its words are frequent."""
    schema = _schema(WORDS)

    def add_up(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        held = [(r["chunk"], r["lang"], split(r["words"]), unpacked(r["counts"], "<i4").tolist(), r["local"]) for r in t.to_pylist()]
        totals: dict[str, defaultdict] = defaultdict(lambda: defaultdict(int))
        for _, lang, words, counts, _ in held:
            total = totals[lang]
            for w, c in zip(words, counts):
                total[w] += c
        often = [(lang, w, total[w]) for lang, total in sorted(totals.items()) for w in sorted(total) if total[w] >= least]
        number = {(lang, w): i * parts + key[0].as_py() for i, (lang, w, _) in enumerate(often)}
        out = []
        if often:
            langs, words, f = zip(*often)
            out += _rows(schema, len(often), lang=langs, phrase=[w.decode("utf-8", "replace") for w in words], f=f, id=list(number.values()))
        sent = []
        for chunk, lang, words, _, local in held:
            ids = np.fromiter((number.get((lang, w), -1) for w in words), np.int64, len(words))
            if (stay := ids >= 0).any():
                sent.append((chunk, steps(places(local)[stay]), packed(ids[stay])))
        if sent:
            chunk, local, ids = zip(*sent)
            out += _rows(schema, len(sent), chunk=chunk, local=local, ids=ids)
        return pa.Table.from_batches(out, schema=schema)

    return rows.groupBy("part").applyInArrow(add_up, WORDS)


def by_chunk(found: DataFrame, groups: str) -> DataFrame:
    """(c, known): for each chunk what the parts told it."""
    return found.where("ids IS NOT NULL").groupBy(F.col("chunk").alias("c")).agg(F.collect_list(F.struct(groups, "ids")).alias("known"))


def numbers(known: list[dict], size: int) -> np.ndarray:
    """By a chunk's own numbers those that frequent groups have everywhere, -1 for
    the others."""
    number = np.full(size, -1, np.int64)
    for x in known:
        number[places(x["local"])] = unpacked(x["ids"], "<i8")
    return number


def _each(batches):
    """The rows of all batches as dicts, one at a time."""
    for b in batches:
        for i in range(b.num_rows):
            yield {name: b.column(name)[i].as_py() for name in b.schema.names}


RELATION_1 = "chunk long, own int, next_place binary, next_word binary"
RELATION = "chunk long, place binary, head binary, next_place binary, next_word binary"


def word_relation(cut: DataFrame, found: DataFrame) -> DataFrame:
    """(chunk, own, next_place, next_word): occurrences of frequent words, by place."""
    schema = _schema(RELATION_1)

    def run(batches):
        for r in _each(batches):
            ids = unpacked(r["ids"], "<i4")
            word = numbers(r["known"], int(ids.max()) + 1)[ids]
            place = np.flatnonzero(word >= 0)
            yield _row(schema, chunk=r["chunk"], own=r["own"], next_place=steps(place), next_word=packed(word[place]))

    return (cut.where("ids IS NOT NULL").select("chunk", "own", "ids").join(by_chunk(found, "local"), F.col("chunk") == F.col("c")).drop("c")
            .mapInArrow(run, RELATION_1))


def merged(r: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Merge-join of a chunk's (place, head), phrases of k - 1 words, with (next_place,
    next_word) on place + k - 1; the words themselves are the first heads, in the
    chunk's own places.  (next_place, next_word, place, code), a code holding the
    numbers of head and next word."""
    at, word = places(r["next_place"]), unpacked(r["next_word"], "<i8")
    if k == 2:
        first = np.searchsorted(at, r["own"])
        place, head = at[:first], word[:first]
    else:
        place, head = places(r["place"]), unpacked(r["head"], "<i8")
    there = np.minimum(np.searchsorted(at, place + (k - 1)), max(len(at) - 1, 0))
    met = np.flatnonzero(at[there] == place + (k - 1)) if len(at) else np.zeros(0, np.int64)
    place, head, tail = place[met], head[met], word[there[met]]
    if len(met) and max(int(head.max()), int(tail.max())) >= 1 << 31:
        raise OverflowError("more than 2**31 frequent phrases of one length")
    return at, word, place, (head << 32) | tail


def pair_counts(relation: DataFrame, k: int, parts: int) -> DataFrame:
    """Each chunk's distinct pairs with their counts, by parts."""
    schema = _schema(PAIR_ROW)

    def run(batches):
        for r in _each(batches):
            codes, counts = np.unique(merged(r, k)[3], return_counts=True)
            part = (mix(codes.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(parts + 1)).tolist()
            rows = [(i, order[x:y]) for i, (x, y) in enumerate(zip(ends, ends[1:])) if y > x]
            for at in range(0, len(rows), 1024):
                some = rows[at:at + 1024]
                yield from _rows(schema, len(some), part=[i for i, _ in some], chunk=r["chunk"], codes=[steps(codes[x]) for _, x in some],
                                 counts=[packed(counts[x].astype("<i4")) for _, x in some])

    return relation.mapInArrow(run, PAIR_ROW)


COUNTED = "head long, word long, f long, id long, chunk long, codes binary, ids binary"


def counted(pairs: DataFrame, least: int, parts: int) -> DataFrame:
    """What the parts find: a row (head, word, f, id) for each frequent pair, and
    rows (chunk, codes, ids) that tell a chunk which of its pairs are frequent."""
    schema = _schema(COUNTED)

    def add_up(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        codes = [places(x) for x in t.column("codes").to_pylist()]
        ends = np.cumsum([0] + [len(c) for c in codes]).tolist()
        every, counts = np.concatenate(codes), np.concatenate([unpacked(x, "<i4") for x in t.column("counts").to_pylist()])
        del codes
        order = np.argsort(every, kind="stable")
        first = np.flatnonzero(np.diff(every[order], prepend=-1))
        f = np.add.reduceat(counts[order], first, dtype=np.int64)
        often = f >= least
        number = np.where(often, (np.cumsum(often) - 1) * parts + key[0].as_py(), -1)
        mine = np.empty(len(every), np.int64)
        mine[order] = np.repeat(number, np.diff(first, append=len(order)))
        code = every[order][first[often]]
        out = list(_rows(schema, len(code), head=code >> 32, word=code & 0xFFFFFFFF, f=f[often], id=number[often]))
        sent = []
        for chunk, x, y in zip(t.column("chunk").to_pylist(), ends, ends[1:]):
            ids = mine[x:y]
            if (stay := ids >= 0).any():
                sent.append((chunk, steps(every[x:y][stay]), packed(ids[stay])))
        if sent:
            chunks, codes, ids = zip(*sent)
            out += _rows(schema, len(sent), chunk=chunks, codes=codes, ids=ids)
        return pa.Table.from_batches(out, schema=schema)

    return pairs.groupBy("part").applyInArrow(add_up, COUNTED)


def kept(relation: DataFrame, found: DataFrame, k: int, longest: int) -> DataFrame:
    """Semi-join of the merged occurrences with the frequent pairs: (chunk, place,
    head, next_place, next_word); of the words those stay that a longer phrase can
    still reach."""
    schema = _schema(RELATION)

    def run(batches):
        for r in _each(batches):
            at, word, place, code = merged(r, k)
            codes = np.concatenate([places(x["codes"]) for x in r["known"]])
            ids = np.concatenate([unpacked(x["ids"], "<i8") for x in r["known"]])
            order = np.argsort(codes)
            codes, ids = codes[order], ids[order]
            there = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            stay = codes[there] == code
            place, head = place[stay], ids[there[stay]]
            reached = np.zeros(int(at[-1]) + longest + 1, bool)
            for step in range(k, longest):
                reached[place + step] = True
            reached = reached[at]
            yield _row(schema, chunk=r["chunk"], place=steps(place), head=packed(head), next_place=steps(at[reached]), next_word=packed(word[reached]))

    return relation.join(by_chunk(found, "codes"), F.col("chunk") == F.col("c")).drop("c").mapInArrow(run, RELATION)


def phrases(docs: DataFrame, longest: int = 4, least: int = 30) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, k, f) of every phrase of up to ``longest`` words that occurs
    ``least`` times or more, (lang, n) with all word occurrences)."""
    cut = stored(chunks(docs, longest), "chunks")
    parts = min(max(cut.where("ids IS NOT NULL").count(), PARTS[0]), PARTS[1])
    totals = stored(cut.where("n IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    found = stored(counted_words(dealt(cut, parts), least, parts), "counts-1")
    named = stored(found.where("f IS NOT NULL").select("id", "lang", "phrase", "f"), "named-1")
    levels = [named.withColumn("k", F.lit(1))]
    relation = stored(word_relation(cut, found), "occurrences-1")
    discard(cut, found)
    tails = named.select(F.col("id").alias("word"), F.col("phrase").alias("tail"))
    for k in range(2, longest + 1):
        found = stored(counted(pair_counts(relation, k, parts), least, parts), f"counts-{k}")
        named = stored(found.where("f IS NOT NULL").select("head", "word", "f", "id")
                       .join(named.select(F.col("id").alias("head"), "lang", "phrase"), "head").join(tails, "word")
                       .select("id", "lang", F.concat_ws(" ", "phrase", "tail").alias("phrase"), "f"), f"named-{k}")
        levels.append(named.withColumn("k", F.lit(k)))
        before = relation
        if k < longest:
            relation = stored(kept(before, found, k, longest), f"occurrences-{k}")
        discard(before, found)
    every = levels[0]
    for level in levels[1:]:
        every = every.unionByName(level)
    return every.drop("id"), totals


def collocations(docs: DataFrame, longest: int = 4, least: int = 30, scale: int = 2_000_000, covered: int = 80,
                 top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases by
    the score of their weakest cut, ``scale`` * a / (l + r), without phrases of
    which ``covered`` in 100 occurrences lie in one longer phrase."""
    found, totals = phrases(docs, longest, least)
    counts = found.select(F.col("lang").alias("p_lang"), F.col("phrase").alias("part"), F.col("f").alias("part_f"))
    candidates = found.where("k > 1").select("lang", "phrase", "k", F.col("f").alias("a"))
    words = F.split("phrase", " ")

    def join(i, n):
        return F.array_join(F.slice(words, i, n), " ")

    cuts = candidates.select("lang", "phrase", "a", F.explode(F.transform(
        F.sequence(F.lit(1), F.col("k") - 1), lambda c: F.struct(c.alias("cut"), join(F.lit(1), c).alias("left"), join(c + 1, F.col("k") - c).alias("right")))).alias("c"))
    cuts = cuts.select("lang", "phrase", "a", "c.*")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = (cuts.join(counts, (F.col("lang") == F.col("p_lang")) & (F.col(side) == F.col("part")))
                .withColumnRenamed("part_f", name).drop("p_lang", "part", side))
    # wide decimals: the product and the sum may pass 64 bits
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = cuts.withColumn("score", F.expr(f"CAST(CAST({scale} AS DECIMAL(17,0)) * CAST(a AS DECIMAL(20,0)) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS BIGINT)"))
    weakest = (cuts.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("w"))
               .select("lang", "phrase", "a", "w.l", "w.r", "w.score"))

    inner = candidates.where("k > 2").select("lang", F.col("a").alias("longer"), F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("k") - 1), lambda n: F.transform(F.sequence(F.lit(1), F.col("k") - n + 1), lambda i: join(i, n))))).alias("inside"))
    inner = inner.groupBy(F.col("lang").alias("i_lang"), "inside").agg(F.max("longer").alias("longer"))
    kept_ones = (weakest.join(inner, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("inside")), "left")
                 .where(F.col("longer").isNull() | (wide("longer") * 100 < wide("a") * covered)).drop("i_lang", "inside", "longer"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = kept_ones.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(totals.withColumnRenamed("lang", "t_lang"), F.col("lang") == F.col("t_lang")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
