"""Chat formatting with typed content parts.

A turn's content is a list of parts (``type``, ``text``, ``ref``, ``units``): text,
image, audio or document; a plain text is one text part.  A visitor folds over
the parts in order: text is escaped, an attachment becomes a numbered placeholder,
and its reference, its place and the number of tokens that the placeholder stands
for (``units`` x tokens per unit) are recorded.  Attachments are numbered through
a conversation when it is assembled, and stand beside its text.

Template: ``<|start|>role<|message|>content<|end|>`` for each turn.  Inside roles and
texts a backslash is doubled and one is put behind the first character of every
control string (the template's own, and those of other common templates), so
no control string stands inside a text and the text can be read back exactly.

Turns are formatted where they are read.  ``assemble`` then brings each
conversation's turns together in order and streams over them: it writes segments
of bounded length, so a conversation of any length takes bounded memory (one
conversation is still read by one task, as its digest is one chain).

Defined results: null role or text is the empty text; turns are ordered by
(turn, role, text), nulls first, so ties and repeated rows have one order and all
count; rows with a null conversation id form one conversation; an empty table
gives an empty result.  Only the named columns are read, so others never clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>"
PLACEHOLDER = "<|{kind}:{n}|>"
# Control strings of common chat templates, escaped as well.
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<bos>", "<eos>", "<unk>", "<pad>",
           "<start_of_turn>", "<end_of_turn>"]
#: every control string that begins with these two characters is the template's kind
OWN = "<|"
TOKENS_PER_UNIT = {"image": 256, "audio": 25, "document": 512}   # a unit: tile, second, page
SEGMENT_CHARS = 1 << 20

_ALL = "|".join(re.escape(c) for c in [OWN, *CONTROL])
PART = "struct<type:string,text:string,ref:string,units:int>"
TURN_ATTACHMENT = "struct<n:int,type:string,ref:string,tokens:bigint,at:int>"


def escaped(text: Column) -> Column:
    """Reversible escape of a text column (built-in functions only)."""
    doubled = F.replace(F.coalesce(text.cast("string"), F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, f"(?=(?:{_ALL}))(.)", r"$1\\")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S) if "\\" in text else text


def text_parts(text: Column) -> Column:
    """The content of a plain text turn: one text part."""
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"),
                            F.lit(None).cast("string").alias("ref"), F.lit(None).cast("int").alias("units")))


def format_turns(turns: DataFrame, parts: str | None = None) -> DataFrame:
    """(conv_id, turn, role, order_text, piece, loss, attachments) per row of
    (conv_id, turn, role, text) or, with ``parts`` naming a column of typed parts,
    of (conv_id, turn, role, parts).

    ``piece`` is the formatted turn, ``loss`` whether its content is trained on,
    ``attachments`` an array of (n, type, ref, tokens, at): n counts within the turn,
    ``at`` is the placeholder's place in the content.  Unknown part types keep a
    placeholder and stand for no tokens."""
    content = F.col(parts) if parts else text_parts(F.col("text"))
    content = F.coalesce(F.filter(content, lambda p: p.isNotNull()), F.array().cast(f"array<{PART}>"))
    kind = lambda p: F.coalesce(p["type"], F.lit("text"))
    tokens = F.create_map(*[x for k, n in TOKENS_PER_UNIT.items() for x in (F.lit(k), F.lit(n))])
    start = F.struct(F.lit("").alias("out"), F.array().cast(f"array<{TURN_ATTACHMENT}>").alias("files"))

    def visit(acc: Column, p: Column) -> Column:
        is_text = kind(p) == "text"
        n = F.size(acc["files"]) + 1
        hole = F.concat(F.lit("<|"), F.regexp_replace(kind(p), "[^A-Za-z0-9_]", "_"), F.lit(":"), n.cast("string"), F.lit("|>"))
        expanded = F.coalesce(p["units"], F.lit(1)).cast("long") * F.coalesce(F.try_element_at(tokens, kind(p)), F.lit(0))
        file = F.struct(n.alias("n"), kind(p).alias("type"), p["ref"].alias("ref"), expanded.alias("tokens"), F.length(acc["out"]).alias("at"))
        return F.struct(F.concat(acc["out"], F.when(is_text, escaped(p["text"])).otherwise(hole)).alias("out"),
                        F.when(is_text, acc["files"]).otherwise(F.array_append(acc["files"], file)).alias("files"))

    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    visited = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
                           *([] if parts else [F.coalesce(F.col("text").cast("string"), F.lit("")).alias("order_text")]),
                           F.aggregate(content, start, visit).alias("flat"))
    return visited.select(
        "conv_id", "turn", "role", F.col("flat.out").alias("order_text") if parts else F.col("order_text"),
        F.concat(F.lit(START), escaped(F.col("role")), F.lit(MESSAGE), F.col("flat.out"), F.lit(END)).alias("piece"),
        (F.col("role") == "assistant").alias("loss"), F.col("flat.files").alias("attachments"))


ATTACHMENT = "struct<n:long,type:string,ref:string,tokens:long,offset:long>"
_ATTACHMENT = pa.list_(pa.struct([("n", pa.int64()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64()), ("offset", pa.int64())]))
SEGMENT = f"conv_id long, segment long, last boolean, text string, loss array<struct<start:long,end:long>>, attachments array<{ATTACHMENT}>"
_SEGMENT = pa.schema([("conv_id", pa.int64()), ("segment", pa.int64()), ("last", pa.bool_()), ("text", pa.string()),
                      ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("attachments", _ATTACHMENT)])


def numbered(piece: str, files: list[dict], seen: int) -> tuple[str, list[int]]:
    """A turn's piece with its placeholders numbered on from ``seen``, and their
    places in it."""
    begin, out, places, at, size = piece.index(MESSAGE) + len(MESSAGE), [], [], 0, 0
    for i, f in enumerate(files):
        start = begin + f["at"]
        end = piece.index("|>", start) + 2
        kind = piece[start + 2:piece.rindex(":", start, end)]
        out += [piece[at:start], PLACEHOLDER.format(kind=kind, n=seen + i + 1)]
        size += start - at
        places.append(size)
        size += len(out[-1])
        at = end
    return "".join(out) + piece[at:], places


def assemble(formatted: DataFrame) -> DataFrame:
    """Conversations as segments, in order: ``loss`` holds code point ranges of
    the whole formatted conversation that are under the loss mask, ``attachments``
    those of the segment, with their places in the whole conversation."""
    ordered = (formatted.select("conv_id", "turn", "role", "order_text", "piece", "loss", "attachments")
               .repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "order_text").drop("turn", "role", "order_text"))

    def run(batches):
        rows: list[dict] = []
        held: dict | None = None      # the segment that is being filled
        for b in batches:
            for conv, piece, loss, files in zip(*(b.column(i).to_pylist() for i in range(4))):
                if held is not None and held["conv_id"] != conv:
                    rows.append(close(held, True))
                    held = None
                if held is None:
                    held = {"conv_id": conv, "segment": 0, "text": [], "size": 0, "at": 0, "seen": 0, "loss": [], "files": []}
                elif held["size"] >= SEGMENT_CHARS:
                    rows.append(close(held, False))
                    held |= {"segment": held["segment"] + 1, "text": [], "size": 0, "loss": [], "files": []}
                if files:
                    piece, places = numbered(piece, files, held["seen"])
                    held["files"] += [{"n": held["seen"] + i + 1, "type": f["type"], "ref": f["ref"], "tokens": f["tokens"], "offset": held["at"] + p}
                                      for i, (f, p) in enumerate(zip(files, places))]
                    held["seen"] += len(files)
                if loss:
                    # the first MESSAGE mark is the turn's own: roles are escaped
                    held["loss"].append({"start": held["at"] + piece.index(MESSAGE) + len(MESSAGE),
                                         "end": held["at"] + len(piece) - len(END)})
                held["text"].append(piece)
                held["size"] += len(piece)
                held["at"] += len(piece)
                if sum(len(r["text"]) for r in rows) >= SEGMENT_CHARS:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SEGMENT)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_SEGMENT)
                rows = []
        if held is not None:
            yield pa.RecordBatch.from_pylist([close(held, True)], schema=_SEGMENT)

    def close(held: dict, last: bool) -> dict:
        return {"conv_id": held["conv_id"], "segment": held["segment"], "last": last, "text": "".join(held["text"]),
                "loss": list(held["loss"]), "attachments": held["files"]}

    return ordered.mapInArrow(run, SEGMENT)


_MARK = re.compile(r"<\|(start|message|end)\|>")


def parse(text: str) -> Iterator[tuple[str, str, int, int]]:
    """(role, content, start, end) of every turn of a formatted text; role
    unescaped, content still escaped, the offsets those of the content."""
    at, role = None, ""
    for m in _MARK.finditer(text):
        if m[1] == "start":
            at = m.end()
        elif m[1] == "message":
            role, at = unescape(text[at:m.start()]), m.end()
        else:
            yield role, text[at:m.start()], at, m.start()


READ = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
        f"attachments array<{ATTACHMENT}>")
_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                   ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("attachments", _ATTACHMENT)])


def read_back(segments: DataFrame) -> DataFrame:
    """Digests of the turns and of the text under the loss mask, parsed from the
    segments, which must come as ``assemble`` returns them (in order), and the
    conversation's attachments, each checked to have its placeholder."""
    def run(batches):
        state = None
        for b in batches:
            rows = []
            for conv, segment, last, text, loss, files in zip(*(b.column(i).to_pylist() for i in range(6))):
                if segment == 0:
                    state = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0, "files": []}
                for f in files:
                    if not text.startswith("<|", at := f["offset"] - state["chars"]) or not text[at:text.index("|>", at)].endswith(f":{f['n']}"):
                        raise ValueError(f"conversation {conv}: attachment {f['n']} has no placeholder")
                state["files"] += files
                for role, content, _, _ in parse(text):
                    state["n"] += 1
                    state["turns"].update(f"{role}\n{unescape(content)}\n".encode("utf-8", "surrogatepass"))
                for r in loss:
                    trained = unescape(text[r["start"] - state["chars"]:r["end"] - state["chars"]])
                    state["loss"].update(trained.encode("utf-8", "surrogatepass"))
                    state["loss_chars"] += len(trained)
                state["chars"] += len(text)
                if last:
                    rows.append((conv, state["n"], state["turns"].hexdigest(), state["loss_chars"],
                                 state["loss"].hexdigest(), state["chars"], state["files"]))
            columns = list(zip(*rows)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _READ)], schema=_READ)

    return segments.mapInArrow(run, READ)
