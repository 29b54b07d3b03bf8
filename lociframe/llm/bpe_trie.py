"""BPE encoding by a prefix-sharing trie.

Every text is cut into pre-tokens.  The distinct new ones of a batch go into a
byte trie in depth-first order.  A node's prefix has one BPE encoding; only its
last token is kept.  The last token of a prefix is the one vocabulary entry that
ends there and may follow the last token of what stands before it, so the state
of a node comes from the states above it, and a prefix that many words share is
encoded once.  A word's ids are read backwards along the last tokens.

Two neighbouring tokens may stand side by side if no merge joins a part of the
left one to a part of the right one before either part is merged away inside
its own token (``Vocabulary.may_follow``).

Map-only: no shuffle, and nothing is kept but a bounded cache of word ids.

Defined results: a null text is an empty text, which has no ids; added special
tokens inside a text become their single id, as the library does by default;
repeated rows are encoded each; an empty table gives an empty result.  Only the
named columns are read, so further columns never clash.
"""

from __future__ import annotations

import hashlib
import json
import sys
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import texts

# The byte-level pre-tokenizer's pattern, as its published
# description states it (white space by its Unicode property).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
           r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")
CACHED = 400_000             # chunks, and words inside chunks, that a task remembers; emptied when full
CACHED_LENGTH = 64           # longer ones are encoded but not kept
PAIRS = 200_000              # pairs of tokens whose neighbourhood a worker remembers
TRIE_NODES = 250_000       # a larger trie starts anew
COMPARED = 24                # bytes compared to find what neighbouring words share
GROUP_CHARS = 1 << 21        # texts whose words are learnt together
LITTLE = sys.byteorder == "little" and array("I").itemsize == 4
NEVER = 1 << 60


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves,
    the others for the letters from U+0100 on, in byte order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Tables of a byte-level BPE tokenizer in the tokenizers library's JSON."""

    def __init__(self, spec: str):
        j = json.loads(spec)
        model, pre = j["model"], j["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or j["normalizer"]
                or pre.get("add_prefix_space") or model.get("dropout") or model.get("ignore_merges")):
            raise ValueError("a byte-level BPE tokenizer without normalizer, prefix space and dropout is needed")
        letters = byte_letters()
        self.id_of: dict[bytes, int] = {}
        self.bytes_of: dict[int, bytes] = {}
        for token, i in model["vocab"].items():
            raw = bytes(letters[c] for c in token)
            self.id_of[raw] = i
            self.bytes_of[i] = raw
        self.special: dict[str, int] = {}
        for t in j["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"]:
                raise ValueError(f"added token {t['content']!r}: stripping and whole words are not supported")
            self.special[t["content"]] = t["id"]
            self.bytes_of[t["id"]] = t["content"].encode()
        self.special_at = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) \
            if self.special else None
        self.rank: dict[tuple[int, int], int] = {}
        made: dict[int, tuple[int, int, int]] = {}
        for r, m in enumerate(model["merges"]):
            left, right = m if isinstance(m, list) else m.split(" ")
            a, b = (self.id_of[bytes(letters[c] for c in x)] for x in (left, right))
            whole = self.id_of[self.bytes_of[a] + self.bytes_of[b]]
            if whole in made:
                raise ValueError("two merges make one token")
            self.rank[a, b] = r
            made[whole] = (a, b, r)
        # the parts of a token that touch its right (left) end, each with the
        # rank of the merge that takes it up; the token itself is never taken up
        self.right_edge: dict[int, list[tuple[int, int]]] = {}
        self.left_edge: dict[int, list[tuple[int, int]]] = {}
        sound = {i for raw, i in self.id_of.items() if len(raw) == 1}
        for i in sound:
            self.right_edge[i] = self.left_edge[i] = [(i, NEVER)]
        for whole, (a, b, r) in made.items():  # in merge order: the parts come first
            self.right_edge[whole] = [(whole, NEVER), (b, r), *self.right_edge[b][1:]]
            self.left_edge[whole] = [(whole, NEVER), (a, r), *self.left_edge[a][1:]]
            if a in sound and b in sound and not self._joins(a, b, r):
                sound.add(whole)
        #: tokens that BPE makes of their own bytes; only these end a prefix
        self.ending = {self.bytes_of[i]: i for i in sound}
        #: all that can stand at the end of a token, to stop a search early
        self.tails = {raw[k:] for raw in self.ending for k in range(len(raw))}
        self.pairs: dict[int, bool] = {}     # left << 32 | right: an int takes less than a tuple

    def _joins(self, a: int, b: int, before: int) -> bool:
        """A merge across the border of a|b comes first, before rank ``before``."""
        rank = self.rank
        for x, x_taken in self.right_edge[a]:
            for y, y_taken in self.left_edge[b]:
                r = rank.get((x, y), NEVER)
                # merges of equal rank go from left to right
                if r < before and r < x_taken and r <= y_taken:
                    return True
        return False

    def may_follow(self, a: int, b: int) -> bool:
        known = self.pairs.get(a << 32 | b)
        if known is None:
            if len(self.pairs) > PAIRS:
                self.pairs.clear()
            known = self.pairs[a << 32 | b] = not self._joins(a, b, NEVER)
        return known

    def last_token(self, word: bytes, depth: int, last: list[int]) -> int:
        """Last token of the prefix word[:depth]; last[d]: that of word[:d]."""
        ending, tails, pairs = self.ending, self.tails, self.pairs
        for at in range(depth - 1, -1, -1):
            tail = word[at:depth]
            token = ending.get(tail)
            if token is None:
                if tail not in tails:
                    break
            elif at == 0:
                return token
            else:
                pair = last[at] << 32 | token
                if pairs[pair] if pair in pairs else self.may_follow(last[at], token):
                    return token
        raise ValueError("no token ends here: the vocabulary lacks single bytes")


def shared_bytes(raws: list[bytes]) -> list[int]:
    """How many leading bytes, ``COMPARED`` at most, each word shares with the one before."""
    out = np.zeros(len(raws), np.int64)
    step = 1 << 14
    for at in range(1, len(raws), step):
        some = raws[at - 1:at + step]
        size = np.fromiter(map(len, some), np.int64, len(some))
        cells = np.array(some, f"S{COMPARED}").view(np.uint8).reshape(len(some), COMPARED)
        other = cells[1:] != cells[:-1]
        n = np.where(other.any(axis=1), other.argmax(axis=1), COMPARED)
        out[at:at + step] = np.minimum(n, np.minimum(size[1:], size[:-1]))
    return out.tolist()


class Trie:
    """Byte trie of the words so far, with the last token of every prefix.

    Words come in sorted, that is in depth-first order: a new node's state
    follows from those above it, and what words share is computed once, also
    between batches.  Nodes are numbers; a full trie starts anew."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.size = vocab, {i: len(b) for i, b in vocab.bytes_of.items()}
        self.child: dict[int, int] = {}      # node << 8 | byte -> node
        self.last: list[int] = [0]           # by node

    def encode(self, words: set[str]) -> dict[str, bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        if len(self.last) > TRIE_NODES:
            self.child, self.last = {}, [0]
        child, states, size, last_token = self.child, self.last, self.size, self.vocab.last_token
        out: dict[str, bytes] = {}
        order = sorted(words)      # by code point, which is the order of their bytes
        raws = [w.encode("utf-8", "surrogatepass") for w in order]
        # last tokens and nodes of the prefixes of the word at hand, of which the next keeps what it shares
        last, path = [0], [0]
        for word, raw, same in zip(order, raws, shared_bytes(raws)):
            del last[same + 1:], path[same + 1:]
            node = path[same]
            for depth, byte in enumerate(raw[same:], same + 1):
                key = node << 8 | byte
                node = child.get(key)
                if node is None:
                    node = child[key] = len(states)
                    states.append(last_token(raw, depth, last))
                last.append(states[node])
                path.append(node)
            ids, at = [], len(raw)
            while at:
                ids.append(last[at])
                at -= size[last[at]]
            ids.reverse()
            out[word] = array("I", ids).tobytes() if LITTLE else np.array(ids, "<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def vocabulary(spec: str) -> Vocabulary:
    return Vocabulary(spec)


class Encoder:
    """Encodes texts; keeps the ids of words and of chunks between blanks.

    A text without two blanks in a row falls apart before every blank: no
    pre-token spans that place, whatever stands around it.  So the chunk is the
    unit of the larger cache, and its pre-tokens are the words of the trie.  A word
    that is a chunk itself is kept as such only."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.trie = vocab, Trie(vocab)
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.split = regex.compile(PATTERN).findall

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of those pieces (uncut texts or chunks) that are not cached;
        what is short enough is cached."""
        if len(self.chunks) > CACHED:
            self.chunks.clear()
        if len(self.words) > CACHED:
            self.words.clear()
        known, chunks = self.words, self.chunks
        new = set(pieces).difference(chunks)
        # a blank and ASCII letters are one pre-token
        whole = {p for p in new if p[:1] == " " and p.isascii() and p[1:].isalpha()}
        cut = {p: self.split(p) for p in new.difference(whole)}
        fresh = {w for ws in cut.values() for w in ws if w not in known and w not in chunks}
        fresh.update(p for p in whole if p not in known)
        fresh = self.trie.encode(fresh)
        parts = {w for ws in cut.values() if len(ws) > 1 for w in ws if w in fresh and w not in new and len(w) <= CACHED_LENGTH}
        known.update((w, fresh[w]) for w in parts)
        ids_of = lambda w: fresh[w] if w in fresh else known[w] if w in known else chunks[w]
        found = {p: ids_of(p) for p in whole}
        found.update((p, ids_of(ws[0]) if len(ws) == 1 else b"".join(map(ids_of, ws))) for p, ws in cut.items())
        long = {p: ids for p, ids in found.items() if len(p) > CACHED_LENGTH}
        for p in long:
            del found[p]
        chunks.update(found)
        return long

    def _pieces(self, text: str) -> list[str]:
        if "  " in text:
            return self.split(text)
        first, *rest = text.split(" ")
        return [first, *[" " + c for c in rest]]

    def _plain(self, parts: list[str]) -> list[bytes]:
        """Ids of texts without special tokens, words learnt for all together."""
        cut = [self._pieces(t) if t else [] for t in parts]
        long = self._learn([p for ps in cut for p in ps])
        get = self.chunks.__getitem__ if not long else lambda p: long[p] if p in long else self.chunks[p]
        return [b"".join(map(get, ps)) for ps in cut]

    def encode_batch(self, batch: list[str]) -> list[bytes]:
        """Ids of every text; groups of texts of bounded size learn together."""
        out: list[bytes] = []
        group, size = [], 0
        for text in batch:
            group.append(text)
            size += len(text)
            if size >= GROUP_CHARS:
                out += self._group(group)
                group, size = [], 0
        return out + self._group(group)

    def _group(self, group: list[str]) -> list[bytes]:
        special, parts, shape = self.vocab.special_at, [], []
        for text in group:
            spans = [(m.start(), m.end()) for m in special.finditer(text)] if special else []
            at, row = 0, []
            for a, b in spans:
                row += [len(parts), self.vocab.special[text[a:b]].to_bytes(4, "little")]
                parts.append(text[at:a])
                at = b
            row.append(len(parts))
            parts.append(text[at:] if at else text)
            shape.append(row)
        ids = self._plain(parts)
        return [b"".join([x if isinstance(x, bytes) else ids[x] for x in row]) if len(row) > 1 else ids[row[0]] for row in shape]

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]


def decode(vocab: Vocabulary, ids: bytes) -> str:
    raw = b"".join(map(vocab.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))
    return raw.decode("utf-8", "replace")


OUTPUT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, tokenizer_json: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for every row.

    ``tokenizer_json`` is the path of the tokenizer's file on the driver; its
    content (a fixed few megabytes) is sent to the executors once.  The decoded
    digest is of the text that the ids give back."""
    with open(tokenizer_json, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        vocab = vocabulary(spec.value)
        encoder = Encoder(vocab)
        for b in batches:
            n, ids_hash, text_hash, all_ids = [], [], [], []
            for ids in encoder.encode_batch(texts(b.column(1))):
                n.append(len(ids) // 4)
                ids_hash.append(hashlib.sha256(ids).hexdigest())
                text_hash.append(hashlib.sha256(decode(vocab, ids).encode("utf-8", "surrogatepass")).hexdigest())
                if with_ids:
                    all_ids.append(np.frombuffer(ids, "<u4").astype(np.int32))
            columns = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                columns.append(pa.array(all_ids, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, OUTPUT + (", ids array<int>" if with_ids else ""))
