"""Secret scans with structural confirmation.

Base kinds are patterns: ``assign`` (a key name, a separator, a value of 12 characters or more), ``access`` (access key
ids) and ``hex`` (runs of 16 lower-case hex digits or more), each leftmost and non-overlapping on its own. On top come
candidates that are decoded and parsed before they are reported: ``jwt`` (three dotted base64url parts whose header
names an algorithm and whose payload is an object), ``key`` (base64 or hex whose bytes are a private key: a DER sequence
with nested lengths that fill it exactly and the fields of PKCS#1, PKCS#8 or SEC1, or an OpenSSH container), and ``pem``
(an armoured block whose body decodes to such a key).

Offsets are code points, ends exclusive, over whole texts. Spans are ordered by start, then kind as listed above. Null
and empty texts have none. Repeated texts give equal spans.
"""

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotejo.llm.common import map_texts

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "jwt", "key", "pem")
PLACEHOLDER = "<secret>"
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_NAMES = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}={0,2}")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{10,})\.([A-Za-z0-9_-]{2,})\.([A-Za-z0-9_-]*)")
_PEM = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----([A-Za-z0-9+/=\s]+)-----END \1-----", re.ASCII)
_HEX_ONLY = re.compile(r"(?:[0-9a-f]{2}){16,}|(?:[0-9A-F]{2}){16,}")
_OPENSSH = b"openssh-key-v1\0"
_SPANS = "array<struct<kind:string,start:int,stop:int>>"


def base_spans(text):
    """(kind order, start, stop) of the base patterns."""
    out = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        out += [(0, m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in _ACCESS.finditer(text)]
    return out + [(2, m.start(), m.end()) for m in _HEX.finditer(text)]


def confirmed_spans(text):
    """(kind order, start, stop) of candidates whose structure holds."""
    out = []
    if "." in text:
        out += [(3, m.start(), m.end()) for m in _JWT.finditer(text) if is_jwt(m[1], m[2])]
    out += [(4, m.start(), m.end()) for m in _RUN.finditer(text) if is_key(decoded(m[0]))]
    if "-----BEGIN" in text:
        out += [(5, m.start(), m.end()) for m in _PEM.finditer(text) if is_key(decoded("".join(m[2].split())))]
    return out


def spans_of(text):
    return sorted(base_spans(text) + confirmed_spans(text), key=lambda s: (s[1], s[0])) if text else []


def decoded(candidate) -> bytes:
    """Bytes of a hex or base64 candidate; none where it is neither."""
    if _HEX_ONLY.fullmatch(candidate):
        return bytes.fromhex(candidate)
    body = candidate.rstrip("=").translate(str.maketrans("-_", "+/"))
    if len(body) % 4 == 1:
        return b""
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (ValueError, binascii.Error):
        return b""


def is_jwt(header, payload):
    try:
        head, body = (json.loads(decoded(part)) for part in (header, payload))
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def _elements(data, low, high):
    """(tag, start, stop) of the DER elements that fill the range, or None."""
    out = []
    while low < high:
        if low + 2 > high:
            return None
        tag, size, low = data[low], data[low + 1], low + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or low + n > high:
                return None
            size, low = int.from_bytes(data[low:low + n], "big"), low + n
            if size < 0x80:
                return None
        if low + size > high:
            return None
        out.append((tag, low, low + size))
        low += size
    return out


def is_key(data):
    """Whether the bytes are a private key by their structure."""
    if data.startswith(_OPENSSH):
        at = len(_OPENSSH)
        for _ in range(3):  # cipher, key derivation, its options: length and text
            size = int.from_bytes(data[at:at + 4], "big")
            if at + 4 > len(data) or at + 4 + size > len(data):
                return False
            at += 4 + size
        return int.from_bytes(data[at:at + 4], "big") >= 1
    if data[:1] != b"\x30":
        return False
    top = _elements(data, 0, len(data))
    if not top or len(top) != 1:
        return False
    inner = _elements(data, top[0][1], top[0][2])
    if not inner or inner[0][0] != 2 or inner[0][2] - inner[0][1] != 1:
        return False
    version, tags = data[inner[0][1]], [t for t, _, _ in inner]
    if version == 1 and len(tags) >= 2 and tags[1] == 4:
        return inner[1][2] - inner[1][1] >= 16  # SEC1
    if version in (0, 1) and tags[1:3] == [0x30, 4]:
        kind = _elements(data, inner[1][1], inner[1][2])
        return bool(kind) and kind[0][0] == 6  # PKCS#8
    return version == 0 and len(tags) >= 9 and set(tags) == {2}  # PKCS#1


def secrets(documents: DataFrame, text="text", keep=None) -> DataFrame:
    """Kept columns plus spans (kind, start, stop) in order."""

    def scan(texts):
        found = [spans_of(t) for t in texts.to_pylist()]
        flat = [s for spans in found for s in spans]
        ends = [0]
        for spans in found:
            ends.append(ends[-1] + len(spans))
        values = pa.StructArray.from_arrays(
            [pa.array([KINDS[s[0]] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.int32()), pa.array([s[2] for s in flat], pa.int32())],
            ["kind", "start", "stop"],
        )
        return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)]

    return map_texts(documents, scan, [("spans", _SPANS)], text, keep)


def listed(spans):
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redacted(documents: DataFrame, text="text") -> DataFrame:
    """The documents with every secret replaced; a null text stays null."""

    def clean(texts):
        return [pa.array([None if t is None else redact(t) for t in texts.to_pylist()], pa.string())]

    packed = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("row_"), documents[text].alias("text_"))
    out = map_texts(packed, clean, [("clean_", "string")], "text_", ["row_"])
    return out.select(*[F.col("clean_").alias(c) if c == text else F.col("row_")[c].alias(c) for c in documents.columns])


def redact(text):
    out, done = [], 0
    for _, start, stop in spans_of(text):
        if start >= done:
            out += [text[done:start], PLACEHOLDER]
        done = max(done, stop)
    return "".join([*out, text[done:]])
