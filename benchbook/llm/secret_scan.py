"""Secret scans: pattern candidates, confirmed by what their decoded bytes are made of."""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from benchbook.llm.common import ready, slices, text_of, unused

#: Order of kinds where two spans start at one place; the first three are the base patterns.
KINDS = ("assign", "access", "hex", "token", "key")

_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of [0-9a-f]+ that are long enough
_ANY_HEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{32,}(?![0-9A-Fa-f])")
_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----")
#: Line ends as they are, or written out as in a JSON text (once or twice escaped).
_LINE_END = r"(?:\\{1,2}r)?(?:\\{1,2}n)|\r?\n"
_ENDS = re.compile(_LINE_END)
_HEADER = re.compile(r"([A-Za-z][A-Za-z0-9-]*):[ \t]*(.*)")
_CIPHER = re.compile(r"[A-Z0-9-]+,([0-9A-Fa-f]+)")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
_NEXT_LINE = re.compile(rf"[ \t]*(?:{_LINE_END})[ \t]*([A-Za-z0-9+/_-]++={{0,2}})")
#: The first character of a base64 text of a JSON object, with or without white space before it.
_SIGNED = re.compile(
    r"(?<![A-Za-z0-9_-])([eICD][A-Za-z0-9_-]{11,}+)\.([A-Za-z0-9_-]++)\.([A-Za-z0-9_-]*+)"
)


def _decoded(run: str) -> bytes | None:
    """Bytes of a base64 run in either alphabet, padded or not."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, start and end of the body of the DER element at ``at``, if its length fits."""
    if at + 2 > end:
        return None
    tag, size, body = data[at], data[at + 1], at + 2
    if size & 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or body + n > end:
            return None
        size, body = int.from_bytes(data[body : body + n], "big"), body + n
        if size < 0x80 or n > 1 and size < 1 << 8 * (n - 1):
            return None  # DER takes the shortest form
    return (tag, body, body + size) if body + size <= end else None


def _well_nested(data: bytes, at: int, end: int, depth: int = 0) -> bool:
    """Whether ``data[at:end]`` is a row of DER elements that fill it exactly, all levels down."""
    if at >= end:
        return False
    while at < end:
        found = _element(data, at, end)
        if found is None:
            return False
        tag, body, stop = found
        if tag & 0x20 and (depth > 12 or body < stop and not _well_nested(data, body, stop, depth + 1)):
            return False
        at = stop
    return True


def key_encoding(data: bytes) -> str | None:
    """Name of the key encoding that ``data`` is, judged by its nested lengths; else None."""
    if data.startswith(b"openssh-key-v1\0"):
        at = 15
        for _ in range(3):  # cipher, derivation, its options
            if at + 4 > len(data):
                return None
            at += 4 + int.from_bytes(data[at : at + 4], "big")
        return "openssh private key" if at + 4 <= len(data) else None
    if len(data) >= 11 and data[:4] in (b"\0\0\0\x07", b"\0\0\0\x0b", b"\0\0\0\x13"):
        size = int.from_bytes(data[:4], "big")
        name = data[4 : 4 + size]
        return "ssh key" if name.startswith((b"ssh-", b"ecdsa-")) else None
    outer = _element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data) or len(data) < 24:
        return None
    if not _well_nested(data, outer[1], outer[2]):
        return None
    first = _element(data, outer[1], outer[2])
    if first is None:
        return None
    if first[0] == 0x02 and first[2] - first[1] == 1:
        second = _element(data, first[2], outer[2])
        if second and second[0] == 0x02:
            return "rsa private key"
        if second and second[0] == 0x30:
            return "pkcs8 private key"
        return "ec private key" if second and second[0] == 0x04 else None
    if first[0] == 0x30:
        second = _element(data, first[2], outer[2])
        if second and second[0] == 0x03:
            return "public key"
        return "encrypted private key" if second and second[0] == 0x04 else None
    return None


def token_header(head: str) -> str | None:
    """Algorithm of a signed token's header, if it is one."""
    data = _decoded(head)
    if data is None:
        return None
    try:
        found = json.loads(data)
    except (ValueError, RecursionError):
        return None
    named = isinstance(found, dict) and isinstance(found.get("alg"), str)
    return f"signed token {found['alg']}" if named else None


def _evidence(value: str) -> str | None:
    """What a candidate's characters prove to be, or None."""
    signed = _SIGNED.match(value)
    if signed and (found := token_header(signed[1])):
        return found
    if len(value) >= 32 and len(value) % 2 == 0 and _ANY_HEX.fullmatch(value):
        if found := key_encoding(bytes.fromhex(value)):
            return found
    if len(value) >= 32 and (data := _decoded(value)):
        return key_encoding(data)
    return None


def block_evidence(body: str) -> str | None:
    """What stands between the BEGIN and END lines of a private key, or None.

    Line ends may be written out, and header lines may come first. An enciphered body cannot be
    parsed: its headers must name a cipher and a start value, and its length must be whole blocks.
    """
    headers, rest = {}, []
    for line in _ENDS.split(body):
        named = _HEADER.fullmatch(line.strip())
        if named and not rest:
            headers[named[1].lower()] = named[2].strip()
        elif line.strip():
            rest.append(line)
    data = _decoded("".join("".join(rest).split()))
    if not data:
        return None
    cipher = _CIPHER.fullmatch(headers.get("dek-info", ""))
    if headers.get("proc-type", "").endswith("ENCRYPTED") and cipher:
        size = len(cipher[1]) // 2
        return "encrypted private key" if size in (8, 16) and len(data) % size == 0 else None
    return key_encoding(data)


def _blocks(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and evidence of the key blocks in a text."""
    for m in _BEGIN.finditer(text):
        stop = text.find("-----", m.end())
        last = f"-----END {m[1]}-----"
        if stop >= 0 and text.startswith(last, stop):
            if found := block_evidence(text[m.end() : stop]):
                yield m.start(), stop + len(last), found


def _tokens(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and evidence of the signed tokens in a text."""
    at = 0
    while m := _SIGNED.search(text, at):
        found = token_header(m[1])
        if found:
            yield m.start(), m.end(), found
        at = m.end() if found else m.end(1)


def _wrapped(text: str) -> Iterator[tuple[int, int, str]]:
    """Start, end and evidence of base64 texts over several lines of one width."""
    done = 0
    for m in _BASE64.finditer(text):
        if m.start() < done or m[0].endswith("="):
            continue
        lines, ends = [m[0]], [m.end()]
        while len(lines[-1]) == len(m[0]) and not lines[-1].endswith("="):
            more = _NEXT_LINE.match(text, ends[-1])
            if more is None or len(more[1]) > len(m[0]):
                break
            lines.append(more[1])
            ends.append(more.end())
        done = ends[-1]
        # the last, shorter line may be a word of what follows
        for n in (len(lines), len(lines) - 1):
            data = _decoded("".join(lines[:n])) if n > 1 else None
            if data and (found := key_encoding(data)):
                yield m.start(), ends[n - 1], found
                break


def scan(text: str) -> list[tuple[str, int, int, bool, str | None]]:
    """Spans ``kind, start, end, confirmed, evidence`` of one text, in order.

    Base spans are always reported, and marked as confirmed if their value decodes into a key or
    a signed token. Other candidates are only reported if they do.
    """
    spans: list[tuple[str, int, int, bool, str | None]] = []
    for m in _ASSIGN.finditer(text):
        if len(m[2]) >= 6:
            found = _evidence(m[2])
            spans.append(("assign", m.start(), m.end(), found is not None, found))
    if "AKIA" in text:
        for m in _ACCESS.finditer(text):
            if len(m[0]) >= 20:
                spans.append(("access", m.start(), m.end(), False, None))
    for m in _HEX.finditer(text):
        found = _evidence(m[0])
        spans.append(("hex", m.start(), m.end(), found is not None, found))
    taken = {(s, e) for _, s, e, _, _ in spans}
    for start, end, found in _tokens(text):
        spans.append(("token", start, end, True, found))
        taken.add((start, end))
    inside = []
    if "-----BEGIN" in text:
        for start, end, found in _blocks(text):
            spans.append(("key", start, end, True, found))
            inside.append((start, end))
    for start, end, found in _wrapped(text):
        if not any(s <= start and end <= e for s, e in inside):
            spans.append(("key", start, end, True, found))
            inside.append((start, end))
    for pattern in (_BASE64, _ANY_HEX):
        for m in pattern.finditer(text):
            at = (m.start(), m.end())
            if at in taken or any(s <= at[0] and at[1] <= e for s, e in inside):
                continue
            if found := _evidence(m[0]):
                spans.append(("key", *at, True, found))
                taken.add(at)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end, *_ in spans)


def redact(text: str, spans: list[tuple], mask: str = "[SECRET]") -> str:
    """The text with every span, overlapping ones together, replaced by ``mask``."""
    parts, at = [], 0
    for _, start, end, *_ in spans:
        if start >= at:
            parts += [text[at:start], mask]
        at = max(at, end)
    return "".join([*parts, text[at:]])


_RESULT = pa.list_(
    pa.struct(
        [
            ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
            ("confirmed", pa.bool_()), ("evidence", pa.string()),
        ]
    )
)


def scan_secrets(df: DataFrame, text: str = "text", spans: str = "spans",
                 redacted: str | None = None) -> DataFrame:
    """Add the spans of all secrets in a text and, on request, the text without them.

    Per row, no shuffle; other columns pass through Python unread. A null text has no spans and
    stays null, an empty one has none. A column of the frame named like a result is replaced.
    Offsets are code points, ends exclusive.
    """
    ready(df.sparkSession)
    added = [spans] + ([redacted] if redacted else [])
    kept = [f for f in df.schema.fields if f.name not in added]
    names = [f.name for f in kept]
    span = T.StructType(
        [
            T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()), T.StructField("confirmed", T.BooleanType()),
            T.StructField("evidence", T.StringType()),
        ]
    )
    clean = [T.StructField(redacted, T.StringType())] if redacted else []
    schema = T.StructType([*kept, T.StructField(spans, T.ArrayType(span)), *clean])
    read = names if text in names else [*names, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, text):
                texts = batch.column(text).to_pylist()
                found = [scan(t) if t else [] for t in texts]
                columns = [batch.column(name) for name in names]
                rows = [
                    [dict(zip(("kind", "start", "end", "confirmed", "evidence"), s)) for s in f]
                    for f in found
                ]
                columns.append(pa.array(rows, type=_RESULT))
                if redacted:
                    clean = [t and redact(t, f) for t, f in zip(texts, found)]
                    columns.append(pa.array(clean, type=pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=names + added)

    return df.select(*[F.col(f"`{n}`") for n in read]).mapInArrow(run, schema)


def without_secrets(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents with every secret masked in their text, and its length brought up to date.

    Every document and column stays, in order. A null text stays null.
    """
    spans = unused(docs, "spans")
    found = scan_secrets(docs, text, spans, redacted=text)
    if n_chars in docs.columns:
        size = F.length(text).cast(docs.schema[n_chars].dataType)
        found = found.withColumn(
            n_chars, F.when(F.size(spans) > 0, size).otherwise(F.col(n_chars))
        )
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def secret_report(df: DataFrame, text: str = "text") -> DataFrame:
    """Counts per base kind and digests of the spans, as the registered query returns them."""
    ids = df.select("doc_id", text_of(text).alias("text"))
    found = scan_secrets(ids).drop("text")

    def n(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def listed(spans):
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return found.select(
        "doc_id",
        n("assign").alias("n_assign"),
        n("access").alias("n_access"),
        n("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["confirmed"])).cast("long").alias("n_confirmed"),
    )
