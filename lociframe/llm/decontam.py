"""Benchmark decontamination by template windows.

Texts become templates: numbers, units and names turn into typed placeholders,
other words are lower-cased.  Windows of ``WINDOW`` template tokens of each
benchmark item are hashed; the documents' windows are hash-joined with them.
Windows that meet at one offset between document and item are one alignment, and
alignments that follow each other in both texts are one chain, as where words
were put into or left out of a copied passage; its offsets may drift by as much
as the item has windows.  It counts as a leak if it covers enough of the item,
and if the values in the placeholders are consistent: a value of the item stands
for one value of the document throughout (the re-parameterised question), but for
a tolerated share of its places; random agreement of placeholders does not give that.

Template tokens: a number (``<num>``), a unit directly behind a number
(``<unit>``), a run of capitalised words inside a sentence (``<name>``), else
the lower-cased word.  Words in capitals are words.  A window needs
``LITERALS`` plain words, so tables of numbers meet nothing by their template.

Whether a word is a name depends on its place and case, so texts have several
forms: ``PLAIN_FORM`` as above; ``KNOWN``, where words that are names elsewhere in
the text are names whatever their case or place; ``FIRST``, where capitalised
words that start a sentence are names too; and, of items only, ``BARE``, without
names, which meets copies in lower case or in capitals.  A document gives the
windows in which its forms differ, and an item is matched form by form.  An item
without a good window in any form is matched by all its tokens as they are
(``EXACT``), one after another; one of fewer than ``LITERALS`` tokens only by a
document that consists of it.

Items that differ in the values of their slots only, and repeat values at the same
places, are consistent with the same documents: they form one *template*, and the
documents are joined, chained and checked against one item of each template.  A
document gives one row per template: with the item whose values it has, found by
an equi-join on all slot values, else with the template's smallest item.  Which
items belong to a template is a table of its own (``templates``).  So the rows
grow with the documents, not with documents x items of one kind.

Scale: a Bloom filter over the benchmark's window hashes (its size is a
parameter, whatever the benchmark) goes to the executors and drops nearly all
document windows before the join; what it lets through by chance the join
removes.  No document text is shuffled.

Defined results: null or empty texts have no windows and are clean; items of
fewer than ``WINDOW`` tokens are one window of their own length; repeated rows are reported once per (id, text); rows with a null
id are reported with a null id; empty tables give an empty result.  Only the named
columns are read, so further columns never clash.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections import defaultdict
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import stored, texts

WINDOW = 8
LITERALS = 4             # plain words that a window must hold
COVERAGE = 0.5           # share of an item's windows that a leak matches ...
RUN = 24                 # ... or so many matched windows of a longer item
CONFLICTS = 0.1          # share of an alignment's slots that may be inconsistent
JUMP = 0.5               # matched windows that a change of the offset must outweigh
BLOOM_BITS = 1 << 24     # 2 MB
PROBES = 2               # bits of the filter for each hash
CACHED_WORDS = 200_000   # words whose class a task remembers
LONG = 64                # characters of a longer piece without spaces, which is not remembered
BLOCK = 1 << 18          # tokens of a text handled at a time

# Units of measure, money and time.
UNITS = set("""% ‰ $ € £ ¥ ° mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t lb lbs oz ton tons
tonne tonnes ml cl l litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week
weeks month months year years km/h mph hz khz mhz ghz w kw v kv a j kj cal kcal pa kpa bar k c f degree degrees percent cent cents
dollar dollars euro euros pound pounds yen usd eur gbp bytes byte kb mb gb tb meter meters metre metres kilogram kilograms gram
grams kilometer kilometers kilometre kilometres""".split())

TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[.!?\n]|[%‰$€£¥°]")
NUM, UNIT, NAME = (xxhash.xxh64_intdigest(x, 1) for x in ("num", "unit", "name"))
PLAIN, NUMBER, TITLE, STOP, UNIT_WORD = 0, 1, 2, 3, 4
PLAIN_FORM, KNOWN, FIRST, BARE, EXACT = 0, 1, 2, 3, 4
LEAF = pa.list_(pa.string())


class Form(NamedTuple):
    """A text's template tokens: hashes, slot types (0: plain word), the word at
    which each stands, and its place among the plain form's tokens."""
    hashes: np.ndarray
    slot: np.ndarray
    at: np.ndarray
    place: np.ndarray


def of_numbers(values: array, kind: type, number_of: np.ndarray) -> np.ndarray:
    return np.frombuffer(values, kind)[number_of] if len(values) else np.zeros(0, kind)


def pieces(text: str) -> list[str]:
    """The text cut at spaces; no token goes beyond a piece.  Line ends, and points
    and commas in front of a space (there they are no part of a number), are cut
    off too, so that most pieces are one token."""
    return text.replace("\n", " \n ").replace(", ", " ").replace(". ", " . ").split(" ")


class TooLong(Exception):
    """A long piece without spaces that holds several tokens."""


class Tokens(dict):
    """Template tokens of texts; a bounded cache keeps the class of known words
    by their number, and the numbers of the words in pieces of other than one."""

    def __init__(self):
        self.start()

    def start(self) -> None:
        self.clear()
        self.hashes, self.kinds, self.several = array("Q"), array("b"), []

    def numbers(self, text: str) -> np.ndarray:
        """The number of each token of a text, as ``TOKEN`` finds them."""
        if len(self) > CACHED_WORDS:
            self.start()
        try:
            found = pieces(text)
            n = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        except TooLong:
            found = TOKEN.findall(text)
            return np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        other = n < 0
        if other.any():      # pieces without a token, or with several
            inside = [self.several[~x] for x in n[other].tolist()]
            size = np.ones(len(n), np.int64)
            size[other] = [len(x) for x in inside]
            n = np.repeat(n, size)
            n[np.repeat(other, size)] = [x for y in inside for x in y]
        return n

    def __missing__(self, w: str) -> int:
        if not w.isalpha():      # letters only are one token
            found = TOKEN.findall(w)
            if found != [w]:
                if len(w) > LONG:
                    raise TooLong
                inside = [self[x] for x in found]
                if len(inside) == 1:
                    n = self[w] = inside[0]
                else:
                    n = self[w] = ~len(self.several)
                    self.several.append(inside)
                return n
        low = w.lower()
        if low in UNITS:
            kind = UNIT_WORD
        elif w.islower():
            kind = PLAIN
        elif w[0].isupper() and w[1:] and not w.isupper():
            kind = TITLE
        elif w[0].isdigit():
            kind = NUMBER
        elif w in ".!?\n":
            kind = STOP
        else:
            kind = PLAIN
        n = self[w] = len(self.kinds)
        self.hashes.append(xxhash.xxh64_intdigest(low.encode("utf-8", "surrogatepass"), 0))
        self.kinds.append(kind)
        return n

    def forms(self, text: str, wanted: tuple = (PLAIN_FORM,)) -> dict[int, Form]:
        """The wanted forms that differ from the plain one, with it."""
        number_of = self.numbers(text)
        own, kind = of_numbers(self.hashes, np.uint64, number_of), of_numbers(self.kinds, np.int8, number_of)
        stop = kind == STOP
        number = kind == NUMBER
        unit = kind == UNIT_WORD
        unit[1:] &= number[:-1]
        unit[:1] = False
        title = kind == TITLE
        inside = title.copy()
        inside[1:] &= ~stop[:-1]
        inside[:1] = False

        def form(name: np.ndarray) -> Form:
            slot = np.where(name, np.int8(3), np.int8(0))
            hashes = np.where(name, np.uint64(NAME), own)
            slot[number], slot[unit] = 1, 2
            hashes[number], hashes[unit] = NUM, UNIT
            keep = ~stop
            keep[1:] &= ~(name[1:] & name[:-1])      # a run of names is one slot
            at = np.flatnonzero(keep)
            return Form(hashes[at], slot[at], at, at)

        plain = form(inside)
        out = {PLAIN_FORM: plain._replace(place=np.arange(len(plain.at)))}
        for f in wanted:
            if f == EXACT:
                at = np.flatnonzero(~stop)
                out[EXACT] = Form(own[at], np.zeros(len(at), np.int8), at, np.arange(len(at)))
                continue
            if f == FIRST:
                name = title
            elif f == KNOWN:
                name = inside
                if inside.any():
                    names = np.sort(own[inside])
                    place = np.minimum(names.searchsorted(own), len(names) - 1)
                    name = inside | (names[place] == own) & ~(number | unit | stop)
            else:
                name = np.zeros(len(kind), bool)
            if f != PLAIN_FORM and (name != inside).any():
                made = form(name)
                out[f] = made._replace(place=np.searchsorted(plain.at, made.at, "right") - 1)
        return out


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(STEP)
    h ^= h >> np.uint64(29)
    return h


STEP = 0x9E3779B97F4A7C15
POWERS = np.cumprod(np.full(BLOCK + 2 * WINDOW, STEP, np.uint64))
INVERSES = np.cumprod(np.full(BLOCK + 2 * WINDOW, pow(STEP, -1, 1 << 64), np.uint64))


def windows(hashes: np.ndarray, slot: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each window, whether it holds enough plain words); the hash is a
    polynomial of the tokens', from prefix sums.  Of longer texts than a block
    the caller gives blocks, or pays for powers of its own."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    powers, inverses = POWERS, INVERSES
    if len(hashes) > len(powers):
        powers, inverses = (np.cumprod(np.full(len(hashes), x, np.uint64)) for x in (STEP, pow(STEP, -1, 1 << 64)))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * inverses[:len(hashes)], out=sums[1:])
    h = mix((sums[width:] - sums[:n]) * powers[:n] + np.uint64(width))
    plain = np.zeros(len(slot) + 1, np.int32)
    np.cumsum(slot == 0, out=plain[1:])
    return h, plain[width:] - plain[:n] >= LITERALS


def differing(form: Form, plain: Form, width: int) -> np.ndarray:
    """Whether each window of a form is not one of the plain form."""
    n = len(form.at) - width + 1
    if n <= 0:
        return np.zeros(0, bool)
    # tokens that differ, or behind which plain tokens are left out
    new = form.hashes != plain.hashes[form.place]
    new[:-1] |= np.diff(form.place) != 1
    sums = np.zeros(len(new) + 1, np.int32)
    np.cumsum(new, out=sums[1:])
    return sums[width:] > sums[:n]


def slot_values(form: Form, words: list[str], start: int, width: int) -> list[str]:
    """"place type value" of the slots of one window; a run of names whole."""
    at, slot, out = form.at, form.slot, []
    for i in range(start, start + width):
        if slot[i]:
            value = words[at[i]].lower()
            if slot[i] == 3:
                k = at[i] + 1
                while k < len(words) and words[k] not in ".!?\n" and (i + 1 >= len(at) or k < at[i + 1]):
                    value += " " + words[k].lower()
                    k += 1
            out.append(f"{form.place[i]} {slot[i]} {value}")
    return out


def item_rows(item, text: str, tokens: Tokens) -> list[tuple]:
    """(item, form, width, hash, pos, slots, n_windows) of one item."""
    forms, words = tokens.forms(text, (KNOWN, FIRST, BARE, EXACT)), TOKEN.findall(text)
    rows = []
    for f, form in sorted(forms.items()):
        n = len(form.hashes)
        width = min(WINDOW, n)
        if f == EXACT:
            if rows or not n:
                continue
            h = windows(form.hashes, form.slot, width)[0]
            # a negative width: all tokens as they are
            rows += [(item, f, -width, int(h[p].view(np.int64)), p, [], len(h)) for p in range(len(h))]
        elif width >= LITERALS:
            h, good = windows(form.hashes, form.slot, width)
            total = len(np.unique(form.place[np.flatnonzero(good)]))
            rows += [(item, f, width, int(h[p].view(np.int64)), int(form.place[p]), slot_values(form, words, int(p), width), total)
                     for p in np.flatnonzero(good)]
    return rows


def values_of(rows: list[tuple]) -> dict[int, list[str]]:
    """By form the slots ("place type value") in the windows of one item, by place."""
    slots = defaultdict(set)
    for _, f, _, _, _, found, _ in rows:
        slots[f].update(found)
    return {f: sorted(x, key=lambda v: int(v.split(" ", 1)[0])) for f, x in slots.items()}


def values_key(slots: list[str]) -> int:
    return np.uint64(xxhash.xxh64_intdigest("\n".join(slots))).astype(np.int64).item()


def template_of(rows: list[tuple]) -> bytes:
    """A digest of an item's windows and of which of its slots have equal values."""
    digest = xxhash.xxh3_128()
    for _, f, width, h, pos, _, _ in rows:
        digest.update(f"{f} {width} {h} {pos};")
    for f, slots in sorted(values_of(rows).items()):
        first: dict = {}
        for i, slot in enumerate(slots):
            place, kind_value = slot.split(" ", 1)
            digest.update(f"{f} {place} {first.setdefault(kind_value, i)};")
    return digest.digest()


def templates(benchmark: DataFrame) -> DataFrame:
    """(item_id, text, template, form, values) of the items, once for each of their
    forms with slots (form -1 if there is none); ``template`` is equal for items
    that differ in slot values only, ``values`` a key of these.  Items without any
    window are not in the table."""
    def run(batches):
        tokens = Tokens()
        for b in batches:
            out = []
            for item, text in zip(b.column(0).to_pylist(), texts(b.column(1))):
                rows = item_rows(item, text, tokens)
                if rows:
                    t = template_of(rows)
                    out += [(item, text, t, f, values_key(v)) for f, v in values_of(rows).items() if v] or [(item, text, t, -1, 0)]
            columns = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.int64()))],
                                             names=["item_id", "text", "template", "form", "values"])

    # one row per (item, text): repeated rows of the benchmark count once
    narrow = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct()
    return narrow.mapInArrow(run, "item_id long, text string, template binary, form int, values long")


def bench_windows(items: DataFrame) -> DataFrame:
    """(item, form, width, hash, pos, slots, n_windows, item_values) of every row of
    (item, text); ``item_values`` is the number of slots of the form."""
    def run(batches):
        tokens = Tokens()
        for b in batches:
            rows = []
            for item, text in zip(b.column(0).to_pylist(), texts(b.column(1))):
                found = item_rows(item, text, tokens)
                size = {f: len(v) for f, v in values_of(found).items()}
                rows += [(*r, size[r[1]]) for r in found]
            columns = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), LEAF, pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["item", "form", "width", "hash", "pos", "item_slots", "n_windows", "item_values"])

    return items.select("item", "text").mapInArrow(
        run, "item long, form int, width int, hash long, pos long, item_slots array<string>, n_windows long, item_values long")


def bloom_of(hashes: DataFrame) -> np.ndarray:
    """Bloom filter (two probes) over ``hash``, merged from the partitions' own;
    bounded by its size, whatever the number of hashes."""
    def run(frames):
        bits = np.zeros(BLOOM_BITS // 8, np.uint8)
        for f in frames:
            h = f["hash"].to_numpy(np.int64).view(np.uint64)
            for i in range(PROBES):
                np.bitwise_or.at(bits, *probe(h, i))
        used = np.flatnonzero(bits)
        yield pd.DataFrame({"at": used, "byte": bits[used].astype(np.int64)})

    parts = hashes.coalesce(8).mapInPandas(run, "at long, byte long").groupBy("at").agg(F.bit_or("byte").alias("byte")).toPandas()
    bits = np.zeros(BLOOM_BITS // 8, np.uint8)
    bits[parts["at"].to_numpy(np.int64)] = parts["byte"].to_numpy(np.int64).astype(np.uint8)
    return bits


def probe(h: np.ndarray, i: int) -> tuple[np.ndarray, np.ndarray]:
    """(byte of the filter, bit of it) for each hash."""
    h = h.view(np.int64)
    p = ((h >> 40 & BLOOM_BITS - 1) ^ (h >> 20 & BLOOM_BITS - 1)) if i else h & BLOOM_BITS - 1
    return p >> 3, np.uint8(1) << (p & 7).astype(np.uint8)


def maybe(bits: np.ndarray, h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Those of the places ``at`` whose hashes may be in the filter; the second
    probe is made where the first passes."""
    for i in range(PROBES):
        byte, bit = probe(h[at], i)
        at = at[bits[byte] & bit != 0]
    return at


def document_windows(docs: DataFrame, bits, widths: list[int]) -> DataFrame:
    """(doc_id, text_key, doc_form, hash, pos, slots) of the windows that may meet the
    benchmark's; long texts are handled in overlapping blocks of tokens."""
    wanted = (KNOWN, FIRST, EXACT) if widths and widths[0] < 0 else (KNOWN, FIRST)

    def hits(forms: dict[int, Form], filter_bits):
        for f, form in forms.items():
            n = len(form.hashes)
            for width in widths:
                if (width < 0) != (f == EXACT) or -LITERALS < width < 0 and n != -width:
                    continue
                wide = abs(width)
                new = differing(form, forms[PLAIN_FORM], wide) if f in (KNOWN, FIRST) else None
                for start in range(0, n, BLOCK):
                    h, good = windows(form.hashes[start:start + BLOCK + wide - 1], form.slot[start:start + BLOCK + wide - 1], wide)
                    if f == EXACT:
                        good[:] = True
                    elif new is not None:
                        good &= new[start:start + len(good)]
                    for k in maybe(filter_bits, h, np.flatnonzero(good)):
                        yield f, form, width, int(h[k].view(np.int64)), start + int(k)

    def run(batches):
        tokens, filter_bits = Tokens(), bits.value
        for b in batches:
            rows = []
            for doc, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), texts(b.column(2))):
                found = list(hits(tokens.forms(text, wanted), filter_bits))
                words = TOKEN.findall(text) if found else []
                rows += [(doc, key, f, width, h, int(form.place[p]), slot_values(form, words, p, width))
                         for f, form, width, h, p in found]
            columns = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), LEAF]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             names=["doc_id", "text_key", "doc_form", "width", "hash", "doc_pos", "doc_slots"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"),
                         F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, text_key long, doc_form int, width int, hash long, doc_pos long, doc_slots array<string>")


def chain(points: list[tuple]) -> list[tuple]:
    """The best run of points (doc_pos, pos, ...), rising in both positions, by
    their number less ``JUMP`` for every change of the offset."""
    points = sorted(points, key=lambda p: (p[0], -p[1]))
    places = sorted({p[1] for p in points})
    tree = [(0.0, -1)] * (len(places) + 1)       # prefix maxima by place in the item
    last: dict[int, tuple[float, int]] = {}
    back, top = [], (0.0, -1)
    for i, (d, p, *_) in enumerate(points):
        place = k = bisect_left(places, p)
        before = (0.0, -1)
        while k > 0:
            before = max(before, tree[k], key=lambda b: b[0])
            k &= k - 1
        came = max(last.get(d - p, (0.0, -1)), (before[0] - JUMP, before[1]), (0.0, -1), key=lambda b: b[0])
        here = (came[0] + 1, i)
        back.append(came[1])
        last[d - p] = here
        top = max(top, here, key=lambda b: b[0])
        k = place + 1
        while k <= len(places):
            tree[k] = max(tree[k], here, key=lambda b: b[0])
            k += k & -k
    out, i = [], top[1]
    while i >= 0:
        out.append(points[i])
        i = back[i]
    return out[::-1]


def consistent(slots: set[tuple]) -> bool:
    """Each value of the item stands for one value of the document, but for a
    small share of the item's slots."""
    places = defaultdict(lambda: defaultdict(set))
    for pos, kind, item, doc in slots:
        places[kind, item][doc].add(pos)
    conflicts = sum(sum(map(len, docs.values())) - max(map(len, docs.values())) for docs in places.values())
    return conflicts <= CONFLICTS * len({s[0] for s in slots})


def best_alignment(points: list[tuple], n_windows: int, exact: bool = False, n_values: int = -1) -> tuple | None:
    """(n_matched, n_slots, n_changed, first_token, values) of the largest leak among
    the chain, the chain without its short links, and each offset alone; or None.
    ``values`` is the key of the document's values if it has one for each of the
    item's ``n_values`` slots."""
    offsets = defaultdict(list)
    for p in points:
        offsets[p[0] - p[1]].append(p)
    tries = list(offsets.values())
    if len(tries) > 1 and not exact:
        whole = chain(points)
        often = defaultdict(int)
        for p in whole:
            often[p[0] - p[1]] += 1
        tries += [whole, [p for p in whole if often[p[0] - p[1]] > 2]]
    best = None
    for found in tries:
        n = len({p[1] for p in found})
        if exact and n < n_windows or n < COVERAGE * n_windows and n < RUN or not n:
            continue
        slots = {s for p in found for s in p[2]}
        if consistent(slots):
            rank = n, -min(p[0] for p in found)
            if best is None or rank > best[0]:
                best = rank, slots
    if best is None:
        return None
    (n, first), slots = best
    whole = len(slots) == n_values == len({s[0] for s in slots})
    key = values_key([f"{p} {kind} {doc}" for p, kind, _, doc in sorted(slots)]) if whole and slots else None
    return n, len(slots), sum(s[2] != s[3] for s in slots), -first, key


def of_one_form(points: list[dict], form: int) -> list[dict]:
    """Without the plain form's points beside which the item's own form has one:
    there a name is cut short ("Lee" of "Anna Lee" at a sentence's start)."""
    own = defaultdict(list)
    for p in points:
        if form != PLAIN_FORM and p["doc_form"] == form:
            own[p["pos"]].append(p["doc_pos"])
    for at in own.values():
        at.sort()

    def beside(p: dict) -> bool:
        at = own.get(p["pos"], ())
        i = bisect_left(at, p["doc_pos"] - WINDOW)
        return i < len(at) and at[i] <= p["doc_pos"] + WINDOW

    return [p for p in points if p["doc_form"] == form or not beside(p)]


ALIGNED = ["doc_id", "text_key", "item", "form", "n_windows", "n_matched", "n_slots", "n_changed", "first_token", "values"]


def best_alignments(batches):
    for b in batches:
        rows = []
        for r in b.to_pylist():
            points = [(p["doc_pos"], p["pos"], [(s["pos"], s["type"], s["item"], s["doc"]) for s in p["slots"]])
                      for p in of_one_form(r["points"], r["form"])]
            found = best_alignment(points, r["n_windows"], r["form"] == EXACT, r["item_values"])
            if found:
                rows.append((r["doc_id"], r["text_key"], r["item"], r["form"], r["n_windows"], *found))
        columns = list(zip(*rows)) if rows else [()] * len(ALIGNED)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=ALIGNED)


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_key, item_id, template, n_items, n_matched, n_windows, coverage,
    n_slots, n_changed, first_token) for every document and template that it leaks:
    its best chain.  ``item_id`` is the template's smallest item with the document's
    slot values, else its smallest; n_changed counts the slots whose value differs
    from that item's; n_items is the number of the template's items."""
    members = stored(templates(benchmark), "bench-items")
    # ids first: a null id stands for a template only where there is no other
    smallest = F.min(F.struct(F.col("item_id").isNull().alias("none"), "item_id", "text")).alias("m")
    kinds = stored(members.groupBy("template").agg(smallest, F.count_distinct(F.struct("item_id", "text")).alias("n_items"))
                   .select(F.monotonically_increasing_id().alias("item"), "template", F.col("m.item_id").alias("smallest"), F.col("m.text").alias("text"), "n_items"),
                   "bench-templates")
    items = stored(bench_windows(kinds), "bench-windows")
    widths = sorted(r.width for r in items.select("width").distinct().collect())
    bits = docs.sparkSession.sparkContext.broadcast(bloom_of(items))
    met = document_windows(docs, bits, widths).join(items, ["width", "hash"])
    # unlike forms share windows by chance only, but for the plain form's
    met = met.where((F.col("doc_form") == F.col("form")) | (F.col("doc_form") == PLAIN_FORM) & (F.col("form") != EXACT))
    # slots of a window are named by their position; the offset aligns them
    part = lambda s, i: F.substring_index(s, " ", i)
    value = lambda s: F.substring(s, F.length(part(s, 2)) + 2, F.length(s))
    pair = lambda d, i: F.struct(part(i, 1).cast("long").alias("pos"), F.element_at(F.split(i, " ", 3), 2).alias("type"),
                                 value(i).alias("item"), value(d).alias("doc"))
    # a neighbourhood of offsets grows with the item only; filed under two, each
    # chain that drifts by less than one lies wholly in one of them
    near = F.floor((F.col("doc_pos") - F.col("pos")) / F.greatest(F.lit(2 * WINDOW), F.col("n_windows")))
    point = F.struct("doc_pos", "pos", "doc_form", F.zip_with("doc_slots", "item_slots", pair).alias("slots"))
    keys = ["doc_id", "text_key", "item", "form", "n_windows", "item_values"]
    groups = (met.select(*keys, F.explode(F.array(near, near + 1)).alias("near"), point.alias("p"))
              .groupBy(*keys, "near").agg(F.collect_set("p").alias("points")))
    matched = F.size(F.array_distinct(F.transform("points", lambda p: p["pos"])))
    hopeful = groups.where((matched >= COVERAGE * F.col("n_windows")) | (matched >= RUN)).drop("near")
    good = hopeful.mapInArrow(best_alignments, ", ".join(f"{c} long" for c in ALIGNED))
    best = F.max_by(F.struct("n_matched", "n_windows", "n_slots", "n_changed", "first_token", "form", "values"),
                    F.struct("n_matched", -F.col("form"), -F.col("first_token"), "n_windows")).alias("b")
    found = good.groupBy("doc_id", "text_key", "item").agg(best).select("doc_id", "text_key", "item", "b.*")
    found = found.join(kinds.select(F.col("item").alias("k_item"), "template", "smallest", "n_items"), F.col("item") == F.col("k_item"))
    # the item whose values the document has
    exact = (members.groupBy(F.col("template").alias("e_template"), F.col("form").cast("long").alias("e_form"), F.col("values").alias("e_values"))
             .agg(F.min("item_id").alias("e_item")))
    same = (F.col("template") == F.col("e_template")) & (F.col("form") == F.col("e_form")) & (F.col("values") == F.col("e_values"))
    found = found.join(exact, same, "left")
    hit = F.col("e_template").isNotNull()
    return found.select("doc_id", "text_key", F.when(hit, F.col("e_item")).otherwise(F.col("smallest")).alias("item_id"),
                        F.lower(F.hex("template")).alias("template"), "n_items", "n_matched", "n_windows",
                        (F.col("n_matched") / F.col("n_windows")).alias("coverage"), "n_slots",
                        F.when(hit, F.lit(0)).otherwise(F.col("n_changed")).cast("long").alias("n_changed"), "first_token")


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that leak an item; all columns stay."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("leak_id"), F.col("text_key").alias("leak_key")).distinct()
    found = stored(found, "leaks")
    # the frames' own columns: other names may clash
    same = docs["doc_id"].cast("long").eqNullSafe(found["leak_id"]) & (F.xxhash64(docs["text"]) == found["leak_key"])
    return docs.join(found, same, "left_anti")
