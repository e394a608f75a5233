"""Secrets in text: plain patterns, and candidates confirmed by decoding them.

Three patterns are reported as they stand. On top of these, runs of base64 or hex, also over several
lines, are decoded and reported where the bytes have the structure of a key: nested DER lengths that add up to the last
byte, the fields of an OpenSSH key, or a signed token whose header names its algorithm. A run that
decodes to just any bytes is not reported. Each row is scanned by itself, so nothing is shuffled.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marlstone.llm.common import col, id_and_text, in_slices

# Fixed values. Kinds in the order that breaks ties between spans with one start.
KINDS = ("assign", "access", "hex", "signed_token", "pem_key", "der_key", "openssh_key")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16
ASSIGN_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % HEX_CHARS)
# Three runs of these with dots between, the first from its first "eyJ" on: a signed token.
TOKEN_RUN = re.compile(r"[A-Za-z0-9_-]+")
PEM_MARK = re.compile(r"(?=-----(BEGIN|END) ([A-Z0-9 ]*PRIVATE KEY)-----)")
# Both alphabets of base64. A run can go on after a line end (real or escaped) and what stands around
# lines that are quoted, commented out or in string literals.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]+={0,2}")
BASE64_KEY = re.compile(
    r"(?<![A-Za-z0-9+/_-])(?:M[A-P][A-Za-z0-9+/_-]{14,}|b3BlbnNzaC1r[A-Za-z0-9+/_-]*)={0,2}"
)
HEX_BYTES = re.compile(r"(?:[0-9a-f]{2}){24,}|(?:[0-9A-F]{2}){24,}")
HEX_RUN = re.compile(r"(?:[0-9A-Fa-f]{2})+")
HEX_KEY = re.compile(
    r"(?<![0-9A-Fa-f])(?:30(?:[0-9A-Fa-f]{2}){11,}|6[Ff]70656[Ee]737368(?:[0-9A-Fa-f]{2})*)"
)
ESCAPED_END = re.compile(r"\\+[nr]")
BETWEEN = re.compile(r"(?:[\s\"'`,;\\>#*|]|[+.&](?=\s)|(?://|--)(?=[ \t]))+")
PEM_END = re.compile(r"\\+[nr]|[\r\n]")
ESCAPED_SLASH = re.compile(r"\\+/")
LITERAL_END = re.compile(r"\s*[\"'`][^A-Za-z0-9]*")
PEM_LINE = re.compile(
    r"(?:[^A-Za-z0-9+/=]|[+/]+(?=[ \t]))*([A-Za-z0-9+/]*={0,2})(?:[^A-Za-z0-9+/=]+[+]?\s*)?"
)
OPENSSH = b"openssh-key-v1\x00"
# Public keys an OpenSSH file may hold; all that write the format put in one.
MOST_KEYS = 16
# Object identifiers of RSA, EC, Ed25519 and X25519 keys, as DER content bytes.
KEY_OIDS = (
    bytes.fromhex("2a864886f70d010101"), bytes.fromhex("2a8648ce3d0201"),
    bytes.fromhex("2b6570"), bytes.fromhex("2b656e"),
)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    found = []
    lower = text.lower()
    if any(name in lower for name in ASSIGN_NAMES):
        found += [
            ("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS
        ]
    if "AKIA" in text:
        found += [
            ("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_CHARS
        ]
    return found + [("hex", *m.span()) for m in HEX.finditer(text)]


def signed_runs(text: str) -> Iterator[tuple[int, int]]:
    """Spans of runs like signed tokens, no two overlapping.

    Where the first "eyJ" of a run begins none, no later one of the same run does.
    """
    at = text.find("eyJ")
    while at >= 0:
        head = TOKEN_RUN.match(text, at).end()
        after = head
        if head > at + 3 and text[head : head + 1] == ".":
            claims = TOKEN_RUN.match(text, head + 1)
            if claims and text[claims.end() : claims.end() + 1] == ".":
                signature = TOKEN_RUN.match(text, claims.end() + 1)
                after = signature.end() if signature else claims.end() + 1
                yield at, after
        at = text.find("eyJ", after)


def pem_blocks(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Start, end, label and body of armoured blocks, none inside another.

    A block ends at the first end mark with the label of its begin mark.
    """
    begins, ends = [], {}
    for mark in PEM_MARK.finditer(text):
        if mark[1] == "BEGIN":
            begins.append((mark.start(), mark[2]))
        else:
            ends.setdefault(mark[2], []).append(mark.start())
    free = 0
    for start, label in begins:
        inside = start + len(f"-----BEGIN {label}-----")
        places = ends.get(label, [])
        n = bisect_left(places, inside)
        if start >= free and n < len(places):
            free = places[n] + len(f"-----END {label}-----")
            yield start, free, label, text[inside : places[n]]


def confirmed_spans(text: str) -> list[Span]:
    """Time grows with the text: no run, block or line is gone through once per place in it."""
    found: list[Span] = []
    if "eyJ" in text:
        found += [("signed_token", a, b) for a, b in signed_runs(text) if is_signed(text[a:b])]
    if "-----BEGIN " in text:
        for start, end, label, body in pem_blocks(text):
            data = from_base64("".join(pem_body(body)))
            encrypted = "ENCRYPTED" in label or "ENCRYPTED" in body
            if data and (
                is_private_der(data) or is_openssh(data) or encrypted and is_ciphered(data)
            ):
                found.append(("pem_key", start, end))
    blocks = [(start, end) for kind, start, end in found if kind == "pem_key"]
    starts = [start for start, _ in blocks]
    # Escaped line ends as real ones of the same length, so that places stay.
    flat = text
    if "\\" in text:
        flat = ESCAPED_END.sub(lambda m: "\n" * len(m[0]), text)
    lines = Lines(flat, BASE64, from_base64, 4, 3)
    for m in BASE64_KEY.finditer(flat):
        n = bisect_right(starts, m.start())
        if not n or m.start() >= blocks[n - 1][1]:
            found += wrapped_key(lines, m)
    for m in HEX_BYTES.finditer(text):
        found += [(kind, *m.span()) for kind in key_kinds(bytes.fromhex(m[0]))]
    lines = Lines(flat, HEX_RUN, from_hex, 2, 1)
    for m in HEX_KEY.finditer(flat):
        found += wrapped_key(lines, m)
    return found


class Lines:
    """Runs that stand alone on the lines of a text, each with those that follow on the next ones.

    `chars` letters of a run hold `per` bytes. The runs of adjacent lines are joined once, however
    many of them a key might begin in, and any part of what follows a run is decoded by itself.
    """

    def __init__(self, text: str, run: re.Pattern, decode: Callable, chars: int, per: int):
        self.text, self.run, self.decode, self.chars, self.per = text, run, decode, chars, per
        # A run that another line leads to: the chain of runs it is in, and its place there.
        self.chain_of: dict[int, tuple[Chain, int]] = {}

    def after(self, start: int, end: int) -> tuple[Chain, int] | None:
        """The chain, and the place in it, that goes on behind a run."""
        if start in self.chain_of:
            chain, place = self.chain_of[start]
            return (chain, place + 1) if place + 1 < len(chain.ends) else None
        first = self._next(end)
        if first is None:
            return None
        if first.start() not in self.chain_of:
            chain, run = Chain(), first
            # What is reached from elsewhere already ends the chain: two runs of one line.
            while run is not None and run.start() not in self.chain_of:
                self.chain_of[run.start()] = (chain, len(chain.ends))
                chain.add(run)
                run = None if run[0].endswith("=") else self._next(run.end())
            chain.join()
        return self.chain_of[first.start()]

    def _next(self, end: int) -> re.Match | None:
        between = BETWEEN.match(self.text, end)
        if between and "\n" in between[0]:
            return self.run.match(self.text, between.end())
        return None


class Chain:
    """Runs of adjacent lines: where each ends, and the letters up to there, padding left out."""

    def __init__(self):
        self.ends, self.totals, self.parts, self.letters = [], [0], [], ""

    def add(self, run: re.Match) -> None:
        bare = run[0].rstrip("=")
        self.ends.append(run.end())
        self.totals.append(self.totals[-1] + len(bare))
        self.parts.append(bare)

    def join(self) -> None:
        self.letters, self.parts = "".join(self.parts), []


class Letters:
    """A run and what follows it on the next lines, without the line ends."""

    def __init__(self, lines: Lines, first: re.Match):
        self.lines, self.own, self.end = lines, first[0].rstrip("="), first.end()
        closed = first[0].endswith("=")
        behind = None if closed else lines.after(first.start(), first.end())
        self.chain, self.place = behind or (Chain(), 0)
        self.from_ = self.chain.totals[self.place]
        self.count = len(self.own) + self.chain.totals[-1] - self.from_

    def part(self, begin: int, end: int) -> str:
        own = len(self.own)
        behind = self.chain.letters[self.from_ + max(begin - own, 0) : self.from_ + max(end - own, 0)]
        return self.own[begin:end] + behind

    def bytes_at(self, begin: int, count: int) -> bytes:
        """`count` bytes, fewer where the letters end."""
        chars, per = self.lines.chars, self.lines.per
        skipped = begin // per
        last = min(-(-(begin + count) // per) * chars, self.count)
        some = self.part(skipped * chars, last)
        some = some[: len(some) // chars * chars] if last < self.count else some
        data = self.lines.decode(some) or b""
        return data[begin - skipped * per :][:count]

    def up_to(self, size: int) -> tuple[int, int] | None:
        """How many letters the runs have that hold so many bytes at last, and where they end."""
        wanted = -(-size * self.lines.chars // self.lines.per)
        if wanted <= len(self.own):
            return len(self.own), self.end
        place = bisect_left(self.chain.totals, wanted - len(self.own) + self.from_)
        if place >= len(self.chain.totals):
            return None
        return len(self.own) + self.chain.totals[place] - self.from_, self.chain.ends[place - 1]


def wrapped_key(lines: Lines, first: re.Match) -> list[Span]:
    """The key that begins with a run and fills it, or it and the runs on the next lines, exactly."""
    letters = Letters(lines, first)
    ssh = letters.bytes_at(0, len(OPENSSH)) == OPENSSH
    size = openssh_size(letters.bytes_at) if ssh else der_size(letters.bytes_at(0, 9))
    reached = size and letters.up_to(size)
    if not reached:
        return []
    count, end = reached
    # What is left over would break the nesting of a DER key, so it need not be decoded.
    if not ssh and count != -(-size * lines.chars // lines.per):
        return []
    return [(kind, first.start(), end) for kind in key_kinds(lines.decode(letters.part(0, count)))]


def der_size(data: bytes) -> int | None:
    """How many bytes a private key has that begins so; None if none does."""
    if len(data) < 9 or data[0] != 0x30:
        return None
    width = data[1] & 0x7F if data[1] & 0x80 else 0
    inner = data[2 + width :]
    if width > 4 or not (inner[:1] == b"\x30" or inner[:3] in (b"\x02\x01\x00", b"\x02\x01\x01")):
        return None
    return 2 + width + (int.from_bytes(data[2 : 2 + width]) if width else data[1])


def secret_spans(text: str) -> list[Span]:
    """All spans, by start, then kind; code points, end exclusive."""
    spans = set(base_spans(text)) | set(confirmed_spans(text))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def from_base64(run: str) -> bytes | None:
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def from_hex(run: str) -> bytes | None:
    return bytes.fromhex(run)


def pem_body(body: str) -> Iterator[str]:
    """The lines of a block without its headers, and without what quotes or escapes them."""
    for line in PEM_END.split(ESCAPED_SLASH.sub("/", body)):
        if ":" not in line and not LITERAL_END.fullmatch(line):
            bare = PEM_LINE.fullmatch(line)
            yield bare[1] if bare else line.strip()


def is_ciphered(data: bytes) -> bool:
    """An encrypted body holds no DER, but whole cipher blocks."""
    return len(data) >= 32 and len(data) % 8 == 0


def key_kinds(data: bytes | None) -> list[str]:
    if not data:
        return []
    if is_openssh(data):
        return ["openssh_key"]
    return ["der_key"] if is_private_der(data) else []


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """Tag and content of each element, or None unless their lengths fill the bytes exactly."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data) or not data[at]:
                return None
            size = int.from_bytes(data[at : at + width])
            at += width
        if at + size > len(data):
            return None
        items.append((tag, data[at : at + size]))
        at += size
    return items


def is_private_der(data: bytes) -> bool:
    """A private key in PKCS#1, SEC1 or PKCS#8 form, plain or encrypted."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = der_items(outer[0][1])
    if not inner or len(inner) < 2:
        return False
    tags = [tag for tag, _ in inner]
    version = inner[0][1]
    if tags[0] == 0x02 and len(version) == 1 and version[0] <= 1:
        if len(inner) >= 9 and set(tags[:9]) == {0x02}:
            return True
        if tags[1] == 0x04 and version[0] == 1 and len(inner[1][1]) in (20, 24, 28, 32, 48, 66):
            return True
        if len(inner) >= 3 and tags[1:3] == [0x30, 0x04]:
            algorithm = der_items(inner[1][1])
            return bool(algorithm) and algorithm[0] in [(0x06, oid) for oid in KEY_OIDS]
        return False
    if tags == [0x30, 0x04] and len(inner[1][1]) >= 16:
        scheme = der_items(inner[0][1])
        return bool(scheme) and scheme[0][0] == 0x06 and scheme[0][1][:4] == b"\x2a\x86\x48\x86"
    return False


def is_openssh(data: bytes) -> bool:
    """Cipher, key derivation, options, and a count of public keys that all fit."""
    size = openssh_size(lambda at, count: data[at : at + count])
    return size is not None and size <= len(data)


def openssh_size(bytes_at: Callable[[int, int], bytes]) -> int | None:
    """Where the last field ends, be it behind the data; None if they end before its length.

    `bytes_at` gives so many bytes from a place on: the lengths are all that is looked at.
    """
    if bytes_at(0, len(OPENSSH)) != OPENSSH:
        return None
    at = len(OPENSSH)
    for _ in range(3):
        length = bytes_at(at, 4)
        if len(length) < 4:
            return None
        at += 4 + int.from_bytes(length)
    count = bytes_at(at, 4)
    keys = int.from_bytes(count)
    at += 4
    if len(count) < 4 or not 1 <= keys <= MOST_KEYS:
        return None
    for _ in range(keys + 1):
        length = bytes_at(at, 4)
        if len(length) < 4:
            return None
        at += 4 + int.from_bytes(length)
    return at


def is_signed(run: str) -> bool:
    """Header and claims are JSON objects, and the header names an algorithm."""
    head, claims, signature = run.split(".")
    try:
        head, claims = (json.loads(from_base64(part) or b"") for part in (head, claims))
    except (ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(claims, dict):
        return False
    algorithm = head.get("alg")
    return isinstance(algorithm, str) and (bool(signature) or algorithm.lower() == "none")


def secret_scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, spans (array of kind, start, end).

    Spans are sorted by start, then by the order of `KINDS`; a place can be reported by several
    kinds. Null and empty texts have no spans. Repeated rows are scanned each for itself; other
    columns of the input are ignored; an empty table gives an empty result.
    """
    rows = id_and_text(df, id_col, text_col)
    schema = (
        f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, "
        "spans array<struct<kind:string,start:bigint,end:bigint>>"
    )
    return rows.mapInArrow(_scan, schema)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(
        pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    )
    for batch in in_slices(batches, "text"):
        spans = [
            [dict(zip(("kind", "start", "end"), s)) for s in secret_spans(text.as_py() or "")]
            for text in batch["text"]
        ]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(spans, kind)], names=["doc_id", "spans"]
        )


def redacted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The same rows and columns, each stretch covered by spans replaced by `[KIND]`.

    Overlapping spans are one stretch, named after its first span. Null texts stay null, empty ones
    empty. Each row is taken by itself, so repeated rows come out alike and other columns as they
    are; an empty table gives an empty result.
    """
    rows = df.select(F.struct("*").alias("row"), col(text_col).alias("text"))

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            texts = batch["text"].to_pylist()
            texts = [t if t is None else redact(t, secret_spans(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(texts, pa.string())], names=["row", "text"]
            )

    done = rows.mapInArrow(replace, rows.schema)
    return done.select(
        *[(F.col("text") if c == text_col else F.col("row")[c]).alias(c) for c in df.columns]
    )


def redact(text: str, spans: list[Span]) -> str:
    out, at = [], 0
    stretches: list[list] = []
    for kind, start, end in spans:
        if stretches and start < stretches[-1][2]:
            stretches[-1][2] = max(end, stretches[-1][2])
        else:
            stretches.append([kind, start, end])
    for kind, start, end in stretches:
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])
