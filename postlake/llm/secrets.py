"""Secret scans through nested encodings.

Each text starts a worklist.  A layer is scanned for secrets, then unwrapped: the whole
layer with its percent escapes decoded, the whole layer with its ``\\u`` escapes decoded,
and each base64 run decoded on its own, at each of the four places its groups can start; runs
that go on over line ends are also decoded joined.  Text in the bytes is a layer, as UTF-8 or
UTF-16, whole or in stretches between other bytes; zlib, gzip, bzip2 and zstandard streams
in them are inflated, all members and frames in a row, and so are the streams inside, until
none is left; large ones in pieces cut where no match can lie across.
New layers go on the worklist until none is left; a layer that was
seen before in the same document is not scanned again, which also ends cycles.  Each
character of a layer carries the span of the original text it came from, so every find
is reported, and can be masked, in the original text.
"""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import re
import urllib.parse
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.llm.common import fresh, map_batches, shipped, text_strings

# fixed values: the patterns and least lengths of the three kinds
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs: a shorter run cannot hold a match
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})")
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
LINE_END = re.compile(r"\r?\n[ \t]*")
LAST_LINE = re.compile(r"\r?\n[ \t]*([A-Za-z0-9+/_-]{1,15}={0,2})(?![A-Za-z0-9+/_-])")
MAGIC = ((b"\x1f\x8b", "gzip"), (b"x\x01", "zlib"), (b"x^", "zlib"), (b"x\x9c", "zlib"), (b"x\xda", "zlib"),
         (b"BZh", "bzip2"), (b"\x28\xb5\x2f\xfd", "zstd"))
INFLATED_BYTES = 64 << 20  # a stream beyond this is read in pieces; an unbroken run beyond it is cut and counted in ``n_refused``
PIECE_BYTES, OVERLAP, LARGE = 8 << 20, 4096, 1 << 20
STREAM = re.compile(rb"\x1f\x8b\x08|x[\x01^\x9c\xda]|BZh[1-9]1AY&SY|\x28\xb5\x2f\xfd")  # where a stream may begin
STRETCH = re.compile(rb"(?:[\t\r\n\x20-\x7e]|[\xc2-\xdf][\x80-\xbf]|[\xe0-\xef][\x80-\xbf]{2}|[\xf0-\xf4][\x80-\xbf]{3}){12,}")  # no find is shorter
WIDE = (re.compile(rb"(?:[\t\r\n\x20-\x7e]\x00){12,}"), re.compile(rb"(?:\x00[\t\r\n\x20-\x7e]){12,}"))  # UTF-16, either byte first
APART = re.compile(rb"[^A-Za-z0-9+/_.=%:\"'\\ \x80-\xff-]")  # bytes that no match and no encoded run can hold

FOUND = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("depth", T.IntegerType())]))
SCANNED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("found", FOUND),
                        T.StructField("masked", T.StringType()), T.StructField("n_refused", T.IntegerType())])

Span = tuple[int, int, int]  # start, end, index of the kind


def scan(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each kind, by start, then kind."""
    spans = [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(*m.span(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(*m.span(), 2) for m in HEX.finditer(text)]
    spans.sort(key=lambda s: (s[0], s[2], s[1]))
    return spans


def magic(data: bytes) -> str | None:
    return next((k for m, k in MAGIC if data.startswith(m)), None)


def opened(kind: str):
    if kind == "bzip2":
        return bz2.BZ2Decompressor()
    if kind == "zstd":
        import zstandard
        return zstandard.ZstdDecompressor().decompressobj()
    return zlib.decompressobj(47)


def stream_starts(data: bytes) -> Iterator[int]:
    """Places where a stream begins: its mark, and a first stretch that can be inflated."""
    for m in STREAM.finditer(data):
        kind = magic(m[0])
        if kind in ("gzip", "zlib"):  # short marks, found by chance in any bytes
            try:
                if not opened(kind).decompress(data[m.start():m.start() + 4096]) and len(data) - m.start() > 4096:
                    continue
            except zlib.error:
                continue
        yield m.start()


def unpacked(data: bytes) -> Iterator[tuple[bytes, int, bool]]:
    """``content`` of a stream, and of the streams between other bytes in what it holds."""
    todo, seen = [(data, 0)], set()
    while todo:
        data, base = todo.pop()
        for made, level, over in content(data):
            yield made, base + level, over
            mark = hashlib.sha1(made).digest()
            if mark not in seen:
                seen.add(mark)
                todo += [(made[at:], base + level) for at in stream_starts(made) if at]


def cut_up(data: bytes) -> Iterator[bytes]:
    return (data[i:i + 1024] for i in range(0, len(data), 1024))


def members(chunks: Iterable[bytes], rest: list) -> Iterator[bytes]:
    """The content of all streams in a row, in small chunks; what follows them is put in ``rest``.

    A stream that breaks off or turns out broken gives what came before.
    """
    chunks, stream, kept = iter(chunks), None, b""
    for chunk in chunks:
        for kept in [kept + chunk] if stream is None else cut_up(chunk):
            while kept:
                if stream is None:
                    kept = kept.lstrip(b"\0")  # padding between members
                    while len(kept) < 8 and (more := next(chunks, b"")):
                        kept += more
                    if kept[1:4] == b"\x2a\x4d\x18" and kept[0] >> 4 == 5:  # a zstandard frame to be skipped
                        end = 8 + int.from_bytes(kept[4:8], "little")
                        while len(kept) < end and (more := next(chunks, b"")):
                            kept += more
                        kept = kept[end:]
                        continue
                    kind = magic(kept)
                    if kind is None:
                        if kept:
                            rest.append(chain([kept], chunks))
                        return
                    stream = opened(kind)
                now, kept = kept[:1024], kept[1024:]
                try:
                    made = stream.decompress(now, 1 << 20) if kind == "bzip2" else stream.decompress(now)
                    if made:
                        yield made
                    while kind == "bzip2" and not stream.eof and not stream.needs_input:
                        yield stream.decompress(b"", 1 << 20)
                except Exception:
                    return
                if stream.eof:
                    kept, stream = stream.unused_data + kept, None


def pieces(chunks: Iterable[bytes]) -> Iterator[tuple[bytes, bool]]:
    """The bytes in pieces of bounded size, and whether a run had to be cut at the end of one."""
    held: list[bytes] = []
    size = due = 0
    for chunk in chunks:
        held.append(chunk)
        size += len(chunk)
        due += len(chunk)
        if due >= PIECE_BYTES:
            whole, due = b"".join(held), 0
            at = next((m.start() for w in (1 << 12, 1 << 16, PIECE_BYTES, len(whole)) for m in reversed(list(
                islice(APART.finditer(whole, max(0, len(whole) - w)), 1 << 16)))), None)
            if at is not None:
                yield whole[:at + 1], False
                whole = whole[at + 1:]
            elif size > INFLATED_BYTES:
                yield whole, True
                whole = whole[-OVERLAP:]
            held, size = [whole], len(whole)
    if size:
        yield b"".join(held), False


def content(data: bytes) -> Iterator[tuple[bytes, int, bool]]:
    """What the streams in ``data`` hold in the end: bytes, how many streams deep, and whether a run was cut."""
    todo, seen = [(data, 0)], set()
    while todo:
        data, level = todo.pop()
        mark = hashlib.sha1(data).digest()
        if mark in seen:  # also a stream that inflates to itself
            continue
        seen.add(mark)
        if level and not magic(data):
            yield from ((piece, level, over) for piece, over in pieces([data]))
            continue
        rest: list = []
        chunks, made, size = members(cut_up(data), rest), [], 0
        for chunk in chunks:
            made.append(chunk)
            size += len(chunk)
            if size > INFLATED_BYTES:
                yield from streamed(chain(made, chunks), level + 1, seen)
                break
        else:
            todo.append((b"".join(made), level + 1))
        todo += [(b"".join(more), level + 1) for more in rest]


def streamed(chunks: Iterator[bytes], level: int, seen: set) -> Iterator[tuple[bytes, int, bool]]:
    """The same for a stream that is too large to hold."""
    first = next(chunks, b"")
    while len(first) < 1 << 16 and (more := next(chunks, b"")):
        first += more
    mark = hashlib.sha1(first).digest()
    if magic(first) is None:
        yield from ((piece, level, over) for piece, over in pieces(chain([first], chunks)))
    elif mark not in seen:
        seen.add(mark)
        rest: list = []
        yield from streamed(members(chain([first], chunks), rest), level + 1, seen)
        for more in rest:
            yield from streamed(iter(more), level + 1, seen)


def readable(data: bytes) -> str | None:
    """Decoded text if the bytes look like text."""
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return text if text and sum(c.isprintable() or c in "\t\r\n" for c in text) >= 0.9 * len(text) else None


def texts_in(data: bytes) -> Iterator[tuple[str, np.ndarray]]:
    """The texts in some bytes, and the byte where each character starts."""
    plain = readable(data)
    stretches = [(0, plain)] if plain is not None else [(m.start(), m[0].decode("utf-8", "replace")) for m in STRETCH.finditer(data)]
    for at, text in stretches:
        sizes = np.array([len(c.encode("utf-8", "replace")) for c in text]) if not text.isascii() else np.ones(len(text), dtype=np.int64)
        yield text, at + np.cumsum(sizes) - sizes
    if b"\0" in data:
        for first, pattern in enumerate(WIDE):
            for m in pattern.finditer(data):
                yield m[0][first::2].decode("ascii"), m.start() + 2 * np.arange(len(m[0]) // 2)


def encoded_runs(text: str) -> Iterator[list[tuple[int, int]]]:
    """Places of each base64 run, and of runs that go on over line ends, joined."""
    held: list[tuple[int, int]] = []

    def joined() -> Iterator[list[tuple[int, int]]]:
        if held and text[held[-1][1] - 1] != "=" and (more := LAST_LINE.match(text, held[-1][1])):
            held.append(more.span(1))
        if len(held) > 1:
            yield held

    for m in BASE64.finditer(text):
        one = m.span()
        yield [one]
        if held and (text[held[-1][1] - 1] == "=" or not LINE_END.fullmatch(text, held[-1][1], one[0])):
            yield from joined()
            held = []
        held.append(one)
    yield from joined()


class Layer:
    """A text and, for each of its characters, where it starts and ends in the original."""

    def __init__(self, text: str, starts: np.ndarray, ends: np.ndarray, depth: int):
        self.text, self.starts, self.ends, self.depth = text, starts, ends, depth

    def spans(self) -> list[Span]:
        return [(int(self.starts[a:b].min()), int(self.ends[a:b].max()), k) for a, b, k in scan(self.text)]

    def replaced(self, pattern: re.Pattern, decode) -> Layer | None:
        """The layer with each match decoded; a decoded character has the span of its match."""
        out, starts, ends, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            made = decode(m[0])
            if made == m[0]:
                continue
            a, b = m.span()
            out += [self.text[at:a], made]
            starts += [self.starts[at:a], np.full(len(made), self.starts[a:b].min())]
            ends += [self.ends[at:a], np.full(len(made), self.ends[a:b].max())]
            at = b
        if not out:
            return None
        out.append(self.text[at:])
        return Layer("".join(out), np.concatenate([*starts, self.starts[at:]]),
                     np.concatenate([*ends, self.ends[at:]]), self.depth + 1)

    def decoded(self, found: str, places: np.ndarray, start: np.ndarray) -> Layer:
        """Text whose characters start at some bytes of the base64 groups at ``places``."""
        last = np.maximum(start, np.concatenate([start[1:] - 1, start[-1:]]))
        # byte i comes from characters 4 * (i // 3) + i % 3 and the next one
        return Layer(found, self.starts[places[4 * (start // 3) + start % 3]],
                     self.ends[places[4 * (last // 3) + last % 3 + 1]], self.depth + 1)

    def unwrapped(self) -> Iterator[tuple[Layer | None, int]]:
        """The layers directly inside, and for each how many runs were cut."""
        text = self.text
        if "%" in text:
            yield self.replaced(PERCENT, lambda s: urllib.parse.unquote_to_bytes(s).decode("utf-8", "replace")), 0
        if "\\u" in text:
            yield self.replaced(ESCAPE, lambda s: chr(int(s[2:], 16))), 0
        for spans in encoded_runs(text):
            whole = "".join(text[a:b] for a, b in spans).rstrip("=").replace("-", "+").replace("_", "/")
            where = np.concatenate([np.arange(a, b) for a, b in spans])
            for phase in range(4):
                run, places = whole[phase:], where[phase:]
                run = run[:len(run) - (len(run) % 4 == 1)]
                try:
                    data = base64.b64decode(run + "=" * (-len(run) % 4))
                except (binascii.Error, ValueError):
                    continue
                for found, start in texts_in(data):
                    if found:
                        yield self.decoded(found, places, start), 0
                for at in stream_starts(data):
                    inside = places[4 * (at // 3) + at % 3:]
                    lo, hi = self.starts[inside].min(), self.ends[inside].max()
                    for made, level, over in unpacked(data[at:]):
                        layers = [Layer(found, np.broadcast_to(lo, len(found)), np.broadcast_to(hi, len(found)), self.depth + level)
                                  for found, _ in texts_in(made)]
                        yield None, int(over)
                        yield from ((layer, 0) for layer in layers)


def worklist(text: str) -> tuple[list[tuple[Span, int]], int]:
    """All spans in the original text with the depth they were first found at.

    Base spans stay as they are; spans that only a decoded layer shows are added.
    """
    depth = {span: 0 for span in scan(text)}
    refused = 0
    seen = {hashlib.sha1(text.encode("utf-8", "replace")).digest()}

    def visit(top: Layer) -> None:
        nonlocal refused
        todo = deque([top])
        while todo:
            for layer, over in todo.popleft().unwrapped():
                refused += over
                if layer is None:
                    continue
                # the same text can come from two places: both are kept, a text inside itself is not
                mark = hashlib.sha1(layer.text.encode("utf-8", "replace") + b"\0%d:%d" % (
                    int(layer.starts[0]) if layer.text else 0, int(layer.ends[-1]) if layer.text else 0)).digest()
                if mark not in seen:
                    seen.add(mark)
                    for span in layer.spans():
                        depth[span] = min(layer.depth, depth.get(span, layer.depth))
                    if len(layer.text) > LARGE:
                        visit(layer)  # at once, so that large layers don't wait side by side
                    else:
                        todo.append(layer)

    if "%" in text or "\\u" in text or BASE64.search(text):
        place = np.arange(len(text), dtype=np.int64)
        visit(Layer(text, place, place + 1, 0))
    return sorted(depth.items(), key=lambda s: (s[0][0], s[0][2], s[0][1])), refused


def mask(text: str, spans: list[Span], mark: str) -> str:
    """The text with each stretch covered by spans replaced once."""
    out, at, covered = [], 0, -1
    for start, end, _ in sorted(spans):
        if start > covered:
            out += [text[at:start], mark]
        covered = max(covered, end - 1)
        at = covered + 1
    return "".join(out) + text[at:]


def scan_secrets(docs: DataFrame, mark: str = "[SECRET]", text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id, found, masked, n_refused`` of every whole text.

    ``found`` lists kind, start, end (code points, end exclusive) and depth (0: in the
    text itself).  A null text is empty and finds nothing, its masked text stays null;
    null keys and repeated rows are kept; other columns are ignored.
    """
    def work(keys, texts):
        plain = texts.to_pylist()
        made = [worklist(t or "") for t in plain]
        return {"doc_id": keys,
                "found": [[{"kind": KINDS[s[2]], "start": s[0], "end": s[1], "depth": d} for s, d in f] for f, _ in made],
                "masked": [t if not f else mask(t, [s for s, _ in f], mark) for t, (f, _) in zip(plain, made)],
                "n_refused": [r for _, r in made]}

    return map_batches(docs.select(docs[key].cast("long"), docs[text].cast("string")), work, SCANNED)


def secret_digests(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Counts and span lists of the same scan, without the masked texts.

    Nulls, empty texts, repeated rows, empty tables and other columns as in ``scan_secrets``.
    """
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_assign", T.LongType()),
                           T.StructField("n_access", T.LongType()), T.StructField("n_hex", T.LongType()),
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType()),
                           T.StructField("n_refused", T.IntegerType())])

    def work(keys, texts):
        out: dict[str, list] = {f.name: [] for f in schema if f.name != "doc_id"}
        for one in text_strings(texts):
            found, refused = worklist(one)
            base = [s for s, d in found if d == 0]
            named = [f"{KINDS[k]}:{a}:{b}" for (a, b, k), _ in found]
            for k, kind in enumerate(KINDS):
                out[f"n_{kind}"].append(sum(s[2] == k for s in base))
            out["base_sha256"].append(hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in base).encode()).hexdigest())
            out["spans"].append(",".join(named))
            out["n_refused"].append(refused)
        return {"doc_id": keys, **out}

    return map_batches(docs.select(docs[key].cast("long"), docs[text].cast("string")), work, schema)


def mask_documents(docs: DataFrame, mark: str = "[SECRET]", refused: Observation | None = None) -> DataFrame:
    """The documents with their secrets masked; columns as before, ``n_chars`` of the new text.

    Null and empty texts stay as they are, repeated rows are masked each, an empty table gives no
    rows, other columns may have any name.  ``refused`` observes the sum of ``n_refused`` when the
    rows are written.
    """
    names, cut = docs.columns, fresh(docs, "_refused")
    shipped(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = batch.column(at).to_pylist()
            made, over = [], []
            for t in texts:
                found, n = worklist(t or "")
                made.append(mask(t, [s for s, _ in found], mark) if found else t)
                over.append(n)
            columns = list(batch.columns)
            columns[at] = pa.array(made, type=pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(over, type=pa.int32())], names=[*batch.schema.names, cut])

    masked = docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(cut, T.IntegerType())]))
    if refused is not None:
        masked = masked.observe(refused, F.coalesce(F.sum(cut), F.lit(0)).alias("n_refused"))
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*names)
