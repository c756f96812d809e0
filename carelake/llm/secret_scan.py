"""Secret scan: fixed patterns, and strings that a dictionary-primed compressor finds new.

Base kinds are patterns, matched from the left without overlap; matches that are too short are dropped:
``assign`` (a sensitive name, a sign, a value), ``access`` (key ids with a fixed prefix) and ``hex`` (long hexadecimal runs).

The method looks at every long run of key characters with letters and digits among them that has a sensitive word shortly before it (``REACH`` bytes). Its novelty is what
it adds to the compressed size of the text around it, per byte: zstandard is primed with a dictionary of code identifiers, and the
context of ``CONTEXT`` bytes on either side is compressed without and with the run. Words, paths and identifiers are mostly
found in the dictionary or nearby; random strings are not, and are reported as ``novel`` from ``NOVELTY`` on, unless a base
span covers them already.

Spans count code points, the end is exclusive. Nulls and edges: null and empty texts have no spans; texts of any length are scanned whole, a
text at a time; repeats are scanned one by one; the other columns pass unread. ``spans`` adds one array column, sorted by start, then kind.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelake.llm.common import utf8

# The base kinds, in order, and their patterns.
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ASSIGN_LEAST = 6
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ACCESS_LEAST = 20
HEX = re.compile(rb"[0-9a-f]{24,}")  # runs are maximal, so the length can stand in the pattern
KINDS = ("assign", "access", "hex", "novel")
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

SENSITIVE = re.compile(
    rb"passw|passphrase|pwd|secret|token|api[ _-]?key|auth|bearer|credential|private|access|signature|client[ _-]?id|connection|login",
    re.I,
)
MARKERS = (
    b"passw", b"passphrase", b"pwd", b"secret", b"token", b"key", b"auth", b"bearer", b"credential", b"private", b"access", b"signature",
    b"client", b"connection", b"login",
)
RUN = re.compile(rb"[A-Za-z0-9+/_=.~-]{16,}")
LETTER, DIGIT = re.compile(rb"[A-Za-z]"), re.compile(rb"[0-9]")
REACH = 48
CONTEXT = 256
NOVELTY = 0.78
NEXT_LINE, NEXT_NOVELTY = 4, 0.66  # a run this close behind a reported one has the like in its surroundings: less is new, if it is random

# Identifiers that stand next to secrets in code and configuration, the compressor's dictionary.
IDENTIFIERS = " ".join("""
    abstract access access_key account action address admin allow api_key apikey application args array async attribute auth
    authentication authorization await base64 bearer boolean branch bucket build callback certificate charset class client
    client_id client_secret cluster commit config configuration connection connection_string const constructor container
    content content-type context controller cookie create credential credentials database debug decode default delete deploy
    description development digest directory domain download email enabled encode encoding endpoint environment error event
    example exception export extends false file filename final float format function gateway getenv git github hash header
    headers host hostname http https image implements import index input instance integer interface internal json key
    keystore lambda length level library license local localhost logger login main master message method module name
    namespace network none null number object options organization os.environ output package parameter parent passphrase
    passwd password path pattern permission placeholder platform policy port prefix private private_key process production
    project property protected protocol provider proxy public public_key query random read redirect refresh_token region
    register release remote repository request require resource response return role root schema scope script secret
    secret_access_key secret_key security select self server service session session_token settings signature signing source
    ssh static status storage string struct super system table target template tenant test throw timeout timestamp token
    true type undefined update upload url user user_id username uuid value variable vault version void webhook window write
""".split()).encode()


def compressor() -> zstandard.ZstdCompressor:
    primed = zstandard.ZstdCompressionDict(IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=3, dict_data=primed, write_content_size=False)


def novelty(packer: zstandard.ZstdCompressor, text: bytes, start: int, end: int) -> float:
    """Compressed bytes that a run adds to its surroundings, per byte of the run."""
    before, after = text[max(0, start - CONTEXT) : start], text[end : end + CONTEXT]
    plain = len(packer.compress(before + after))
    return (len(packer.compress(before + after + text[start:end])) - plain) / (end - start)


def base_spans(text: bytes, low: bytes) -> list[tuple[int, int, int]]:
    """Byte spans of the base kinds: start, place of the kind, end."""
    found = []
    if any(name in low for name in NAMES):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return found


def novel_spans(
    text: bytes, low: bytes, base: list[tuple[int, int, int]], packer: zstandard.ZstdCompressor
) -> list[tuple[int, int, int, float]]:
    """Runs in sensitive context that add much to their surroundings, in one walk over runs, sensitive words and base spans.

    The context of a run is a sensitive word or a reported run up to REACH bytes before it, or a sensitive word up to REACH bytes after it.
    So a block of lines that begins at a sensitive word is measured line by line to its end.
    """
    if not any(marker in low for marker in MARKERS):
        return []
    names = [m.span() for m in SENSITIVE.finditer(text)]
    if not names:
        return []
    found, covers, reach = [], sorted((s, e) for s, _, e in base), 0
    at, ahead, place, last = 0, 0, 0, -REACH - 1
    for run in RUN.finditer(text):
        start, end = run.span()
        while at < len(names) and names[at][1] <= start:
            last, at = max(last, names[at][1]), at + 1
        while ahead < len(names) and names[ahead][0] < end:
            ahead += 1
        while place < len(covers) and covers[place][0] <= start:
            reach, place = max(reach, covers[place][1]), place + 1
        follows = ahead < len(names) and names[ahead][0] - end <= REACH
        if start - last > REACH and not follows:
            continue
        if reach > start or (place < len(covers) and covers[place][0] < end):  # a base span touches the run
            continue
        if not (LETTER.search(run[0]) and DIGIT.search(run[0])):
            continue
        value = novelty(packer, text, start, end)
        beside = found and start - found[-1][2] <= NEXT_LINE
        if value >= (NEXT_NOVELTY if beside else NOVELTY):
            found.append((start, 3, end, value))
            last = end
    return found


def code_points(text: bytes, offsets: list[int]) -> dict[int, int]:
    """Code points before each byte offset, in one walk over the text."""
    found, last, total = {}, 0, 0
    for offset in sorted(set(offsets)):
        total += len(text[last:offset].decode("utf-8", "replace"))
        found[offset], last = total, offset
    return found


def spans_of(text: bytes, packer: zstandard.ZstdCompressor) -> list[dict]:
    low = text.lower()
    base = base_spans(text, low)
    found = [*((s, k, e, None) for s, k, e in base), *novel_spans(text, low, base, packer)]
    if not found:
        return []
    points = code_points(text, [x for s, _, e, _ in found for x in (s, e)])
    return [
        {"kind": KINDS[k], "start": points[s], "end": points[e], "novelty": value}
        for s, k, e, value in sorted(found, key=lambda x: x[:3])
    ]


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("novelty", pa.float64())])


def scan(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
    packer = compressor()
    for column in columns:
        yield pa.array([spans_of(text.as_py(), packer) for text in column], pa.list_(SPAN))


def scanned(docs: DataFrame, text: str = "text", name: str = "secrets") -> DataFrame:
    """``docs`` with an array column ``name`` of spans: kind, start, end, novelty (null for base kinds)."""
    udf = F.arrow_udf(scan, "array<struct<kind:string,start:bigint,end:bigint,novelty:double>>")
    return docs.withColumn(name, udf(utf8(text)))
