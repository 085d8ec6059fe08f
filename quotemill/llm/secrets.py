"""Secret scans by dictionary-primed compression (operator 6).

Patterns give the base spans. The method looks at strings that stand shortly after a sensitive word: a zstandard compressor is
primed with a dictionary of identifiers and the code around the candidate, and the candidate's marginal cost is the bytes it
adds. A string that neither the surroundings nor common identifiers explain is incompressible, and is reported.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The kinds in their order, and their patterns; ASCII letters of the keywords match in either case.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "novel")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
SENSITIVE = re.compile(r"(?ai:passw|passphrase|secret|token|api.?key|credential|authori[sz]ation|bearer|private.?key|access.?key|session.?id)")
SENSITIVE_PARTS = ("passw", "passphrase", "secret", "token", "api", "credential", "authori", "bearer", "private", "access", "session")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Identifiers and placeholders that code is full of.
IDENTIFIERS = (
    "password username user_name account secret_key access_key api_key client_id client_secret token refresh_token access_token "
    "authorization bearer credential private_key public_key session_id example placeholder changeme your_token_here your_api_key "
    "xxxxxxxxxxxxxxxxxxxxxxxx 0123456789abcdef 1234567890 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 00000000000000000000000000000000 "
    "environment configuration connection_string database_url localhost application development production settings default_value"
)
#: Most characters between a sensitive word and a candidate, and least ones of a candidate; characters around it that prime the
#: compressor; least share of its bytes that it must add.
REACH, LEAST_LENGTH, AROUND, LEAST_NOVEL = 48, 16, 512, 0.6


def added_bytes(before: str, candidate: str, after: str) -> int:
    """How many bytes the candidate adds to a frame primed with identifiers and what stands around it."""
    import zstandard

    primed = zstandard.ZstdCompressionDict((IDENTIFIERS + "\n" + after + "\n" + before).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=9, dict_data=primed, write_checksum=False, write_content_size=False, write_dict_id=False)
    tail = before[-64:]
    return len(packer.compress((tail + candidate).encode())) - len(packer.compress(tail.encode()))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind in KINDS, end), sorted."""
    out, low = [], text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int]]:
    """(start, end) of the strings that begin shortly after a sensitive word, in order."""
    out, done = [], 0
    for word in SENSITIVE.finditer(text):
        for m in CANDIDATE.finditer(text, max(word.end(), done), min(len(text), word.end() + REACH + LEAST_LENGTH)):
            m = CANDIDATE.match(text, m.start()) or m  # to its own end, beyond the reach
            if m.start() >= done:
                done = m.end()
                out.append((m.start(), done))
    return out


def value_of(found: str) -> str:
    """The longest part between equals signs, if it is long enough to be a candidate: what `name=value` has in common with its copies."""
    part = max(found.split("="), key=len)
    return part if CANDIDATE.fullmatch(part) else found


def without(text: str, start: int, end: int, cut: list[tuple[int, int]]) -> str:
    out = []
    for a, b in sorted(cut):
        if a < end and b > start:
            out.append(text[start:max(a, start)])
            start = max(start, min(b, end))
    return "".join([*out, text[start:end]])


def novel_spans(text: str, base: list[tuple[int, int, int]], least: float = LEAST_NOVEL) -> list[tuple[int, int, int]]:
    """Copies of a candidate explain it only if they stand before all that follow a sensitive word; later ones are taken out of the
    surroundings, so that a secret that is repeated is reported at each place."""
    low = text.lower()
    if not any(k in low for k in SENSITIVE_PARTS):
        return []
    spans, out, first = candidates(text), [], {}
    values = [value_of(text[a:b]) for a, b in spans]
    for value, (a, _) in zip(values, spans, strict=True):
        first.setdefault(value, a)
    for i, ((start, end), value) in enumerate(zip(spans, values, strict=True)):
        found = text[start:end]
        if any(a < end and start < b for a, _, b in base) or found.isalpha() or found.isdigit():
            continue
        lo, hi, cut = max(0, start - AROUND), min(len(text), end + AROUND), []
        for step in (-1, 1):
            k = i + step
            while 0 <= k < len(spans) and spans[k][1] > lo and spans[k][0] < hi:
                if value in text[slice(*spans[k])] or values[k] in found:
                    cut.append(spans[k])
                k += step
        at = text.find(value, max(first[value], lo - len(value)))
        while 0 <= at < hi:
            cut.append((at, at + len(value)))
            at = text.find(value, at + 1)
        if added_bytes(without(text, lo, start, cut), found, without(text, end, hi, cut)) >= least * len(found):
            out.append((start, 3, end))
    return out


def _named(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[SECRET]") -> str:
    """The text with each maximal covered stretch replaced; of an assignment the whole match goes."""
    out, at = [], 0
    for a, _, b in sorted(spans):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def _columns(docs: DataFrame, names: list[str]) -> list[str]:
    return [c for c in docs.columns if c not in names]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, span_texts. A null text is empty; equal rows give equal results."""
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, span_texts array<string>"

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[list, list, list] = ([], [], [])
            digests, spans, texts = [], [], []
            for text in batch["text"]:
                text = text.as_py() or ""
                base = base_spans(text)
                found = sorted(base + novel_spans(text, base))
                for k in range(3):
                    counts[k].append(sum(x[1] == k for x in base))
                digests.append(hashlib.sha256(_named(base).encode()).hexdigest())
                spans.append(_named(found))
                texts.append([text[a:b] for a, _, b in found])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(texts, pa.list_(pa.string()))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "span_texts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(look, schema)


def redact(docs: DataFrame) -> DataFrame:
    """The same columns; secrets in `text` are replaced by a mark and `n_chars`, if there, is counted anew. Null texts stay null."""
    names = docs.columns

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text in batch["text"]:
                text = text.as_py()
                if text is not None:
                    base = base_spans(text)
                    spans = base + novel_spans(text, base)
                    text = redacted(text, spans) if spans else text
                texts.append(text)
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    out = docs.mapInArrow(clean, docs.schema)
    counted = F.when(F.col("text").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType) if "n_chars" in names else None
    return out.withColumn("n_chars", counted).select(*names) if counted is not None else out
