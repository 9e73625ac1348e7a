"""Secrets in texts: keyword automaton first, anchored expressions only at its hits, then checksums.

One automaton holds every word a secret can start with, and all runs of four hex
digits. It reads each text once, in ASCII lower case. Where it hits, and only there,
an expression is matched at that place of the original text. Kinds with an embedded
checksum keep only candidates whose checksum is right.

Kinds, in the order of equal starts:

* ``assign``, ``access``, ``hex``: leftmost, non-overlapping per kind; matches that are too short
  are passed over but still use up their text.
* ``github``: ``ghp_``, ``gho_``, ``ghu_``, ``ghs_`` or ``ghr_`` and 36 characters, the last six of them the
  base-62 CRC-32 of the 30 before.
* ``npm``: ``npm_`` and 36 characters with the same checksum.
* ``pgp``: an armoured private key block whose CRC-24 line fits its data.
"""

from __future__ import annotations

import base64
import binascii
import re
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.store import map_batches
from adtally.llm.wordhash import slices

KINDS = ["assign", "access", "hex", "github", "npm", "pgp"]
BASE = KINDS[:3]
#: What each kind's candidates look like. Group 2 of ``assign`` is the secret itself.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
PREFIXED = {"github": re.compile(r"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"), "npm": re.compile(r"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")}
PGP = re.compile(r"-----BEGIN PGP PRIVATE KEY BLOCK-----\r?\n(?:[A-Za-z]+: [^\n]*\n)*\r?\n((?:[A-Za-z0-9+/=]+\r?\n)+)=([A-Za-z0-9+/]{4})\r?\n-----END PGP PRIVATE KEY BLOCK-----")
WORDS = {"assign": ["password", "passwd", "secret", "token", "apikey", "api_key"], "access": ["akia"], "github": ["ghp_", "gho_", "ghu_", "ghs_", "ghr_"], "npm": ["npm_"], "pgp": ["-----begin pgp private"]}
LEAST = {"assign": 6, "access": 20, "hex": 24}
ALPHABET = string.digits + string.ascii_uppercase + string.ascii_lowercase


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in WORDS.items():
        for w in words:
            found.add_word(w, (kind, len(w)))
    for digits in product("0123456789abcdef", repeat=4):
        found.add_word("".join(digits), ("hex", 4))
    found.make_automaton()
    return found


def checksum62(data: str) -> str:
    """CRC-32 in six base-62 digits, as it ends prefixed tokens."""
    n, out = zlib.crc32(data.encode()), ""
    for _ in range(6):
        n, digit = divmod(n, 62)
        out = ALPHABET[digit] + out
    return out


def crc24(data: bytes) -> int:
    """Checksum of armoured blocks (RFC 4880)."""
    crc = 0xB704CE
    for b in data:
        crc ^= b << 16
        for _ in range(8):
            crc <<= 1
            if crc & 0x1000000:
                crc ^= 0x1864CFB
    return crc


def _valid_block(m: re.Match) -> bool:
    try:
        body = base64.b64decode("".join(m[1].split()), validate=True)
        return crc24(body) == int.from_bytes(base64.b64decode(m[2]), "big")
    except (binascii.Error, ValueError):
        return False


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end (code points, end exclusive) by start, then kind as listed."""
    low = text.lower() if text.isascii() else text.encode().lower().decode()
    hits = [(end + 1 - size, kind) for end, (kind, size) in _automaton().iter(low)]
    if not hits:
        return []
    hits.sort()
    out, used = [], dict.fromkeys(KINDS, 0)
    for at, kind in hits:
        if at < used[kind]:
            continue
        if kind == "assign":
            if m := ASSIGN.match(text, at):
                used[kind] = m.end()
                if len(m[2]) >= LEAST[kind]:
                    out.append((kind, at, m.end()))
        elif kind in ("access", "hex"):
            if m := (ACCESS if kind == "access" else HEX).match(text, at):
                used[kind] = m.end()
                if m.end() - at >= LEAST[kind]:
                    out.append((kind, at, m.end()))
        elif kind == "pgp":
            if (m := PGP.match(text, at)) and _valid_block(m):
                used[kind] = m.end()
                out.append((kind, at, m.end()))
        elif (m := PREFIXED[kind].match(text, at)) and checksum62(m[1]) == m[2]:
            used[kind] = m.end()
            out.append((kind, at, m.end()))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


def redact(text: str, spans: list[tuple[str, int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with each stretch of touching or overlapping spans replaced by ``mark``."""
    parts, at, last = [], 0, -1
    for _, start, end in spans:
        if start > last:
            parts += [text[at:start], mark]
        last = max(last, end)
        at = last
    return "".join([*parts, text[at:]])


def scan_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``spans``, an array of (kind, start, end), of every row; nothing is shuffled.

    Defined cases: null and empty texts have no spans; repeated rows and null ids stay one row
    each; very long texts are read whole; an empty table gives no rows; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part in slices(batch, "text"):
                found = [[dict(zip(("kind", "start", "end"), x, strict=True)) for x in find_secrets(t or "")] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, kind)], ["id", "spans"])

    id_type = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return map_batches(rows, run, f"id {id_type}, spans array<struct<kind:string,start:long,end:long>>").withColumnRenamed("id", id_column)


def redact_secrets(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with every secret in its texts replaced; null texts stay null, other columns stay as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            for part in slices(batch, text_column):
                texts = [t if t is None else redact(t, find_secrets(t)) for t in part.column(at).to_pylist()]
                yield part.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return map_batches(docs, run, docs.schema)
