"""Secrets by token efficiency: strings that a public vocabulary needs many tokens for are random.

Three fixed patterns give the base findings. Beyond them, every run of at least :data:`MIN_RUN` key characters
with a letter is encoded with a tiktoken vocabulary; a run with few characters per token is reported unless it is
a known digest (hex of a usual length), a UUID, a number-like identifier or a path of words. Of a run that a base
finding covers in part, each part outside is judged in the same way. Runs without a letter are numbers or rulers.

Null and empty texts have no findings. Each row is judged alone: repeated rows give repeated results, and other
columns are never read. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import doc_columns

# The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24
# Every match of ASSIGN holds one of these in lower case.
HINTS = ("passw", "secret", "token", "api")

KINDS = ("assign", "access", "hex", "token")
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
MIN_RUN = 20
DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
UUID = re.compile(r"[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
HEX_ANY = re.compile(r"[0-9A-Fa-f]+")
# A name of words and numbers, such as build-2024-05-01 or page_12_of_40.
IDENTIFIER = re.compile(r"(?:[A-Za-z][a-z]*|[A-Z]+|[0-9]+)(?:[-_/=+](?:[A-Za-z][a-z]*|[A-Z]+|[0-9]+))*[-_/=+]*")
#: Words of the vocabulary take about four characters a token, invented prose over two, random strings less.
MAX_CHARS_PER_TOKEN = 2.0

SCHEMA = "n_assign long, n_access long, n_hex long, base_spans string, spans string"


def load_encoding(path: str | None = None):
    """The byte-level vocabulary as a tiktoken encoding, from a file of base64 ranks."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str, has_long: bool) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base findings."""
    found = []
    lowered = text.lower()
    if any(hint in lowered for hint in HINTS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if has_long:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= MIN_HEX]
    return sorted(found)


def is_known(run: str) -> bool:
    """Digests, UUIDs and identifiers made of words and numbers: not secrets by themselves."""
    if HEX_ANY.fullmatch(run) and len(run) in DIGEST_LENGTHS or UUID.fullmatch(run):
        return True
    parts = re.split(r"[-_/=+]+", run.strip("-_/=+"))
    if not any(c.isdigit() for c in run):  # a path or an option of words only, such as /a/b/c
        run = run.lstrip("-_/=+")
    return bool(IDENTIFIER.fullmatch(run)) and len(run) < 8 * len(parts) + 8


def outside(start: int, end: int, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Parts of ``start`` to ``end`` that none of the sorted ``spans`` covers."""
    for low, _, high in spans:
        if low < end and start < high:
            if start < low:
                yield start, low
            start = high
    if start < end:
        yield start, end


def random_spans(
    text: str, encoding, max_chars_per_token: float, base: list[tuple[int, int, int]] = ()
) -> list[tuple[int, int, int]]:
    found = []
    for match in RUN.finditer(text):
        if match.end() - match.start() < MIN_RUN:
            continue
        for start, end in outside(match.start(), match.end(), base):
            run = text[start:end]
            if len(run) < MIN_RUN or not any(c.isalpha() for c in run) or is_known(run):
                continue
            if len(run) <= max_chars_per_token * len(encoding.encode_ordinary(run)):
                found.append((start, 3, end))
    return found


def scan(text: str | None, encoding, max_chars_per_token: float = MAX_CHARS_PER_TOKEN) -> tuple:
    text = text or ""
    # Findings of the last three kinds lie within one word, which is then at least this long.
    has_long = max(map(len, text.split()), default=0) >= min(MIN_ACCESS, MIN_HEX, MIN_RUN)
    base = base_spans(text, has_long)
    more = random_spans(text, encoding, max_chars_per_token, base) if has_long else []
    write = lambda spans: ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)
    counts = [sum(kind == k for _, kind, _ in base) for k in range(3)]
    return (*counts, write(base), write(sorted(base + more)))


def find_secrets(
    docs: DataFrame, vocabulary: str | None = None, max_chars_per_token: float = MAX_CHARS_PER_TOKEN
) -> DataFrame:
    """All columns of ``docs`` and a struct ``secrets`` of counts and spans (replacing a column of that name)."""

    @F.pandas_udf(SCHEMA)
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoding = load_encoding(vocabulary)
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for texts in batches:
            rows = [scan(text if isinstance(text, str) else None, encoding, max_chars_per_token) for text in texts]
            yield pd.DataFrame(rows, columns=names)

    return docs.withColumn("secrets", scanned(F.col("text")))


def mask_secrets(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced by ``mask`` and ``n_chars`` counted anew.

    Texts without findings, empty and null texts stay as they are; overlapping spans are masked as one.
    """

    @F.pandas_udf("string")
    def masked(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, spans in batches:
            yield pd.Series([cut(text, found, mask) for text, found in zip(texts, spans)], dtype=object)

    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    found = find_secrets(docs.select(row.alias("row"), "text")).withColumn(
        "masked", F.when(F.col("secrets.spans") == "", F.col("text")).otherwise(masked("text", "secrets.spans"))
    )
    columns = {c: F.col(f"row.`{c}`") for c in docs.columns} | {"text": F.col("masked")}
    if "n_chars" in columns:
        counted = F.char_length("masked").cast(docs.schema["n_chars"].dataType)
        columns["n_chars"] = F.when(F.col("secrets.spans") == "", columns["n_chars"]).otherwise(counted)
    return found.select(*[column.alias(c) for c, column in columns.items()])


def cut(text: str | None, spans: str, mask: str) -> str | None:
    if not spans or not isinstance(text, str):
        return text
    pieces, at = [], 0
    for start, end in sorted(tuple(map(int, span.split(":")[1:])) for span in spans.split(",")):
        if end <= at:
            continue
        if start >= at:
            pieces += [text[at:start], mask]
        at = end
    return "".join([*pieces, text[at:]])


def secret_report(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: counts of base findings, the digest of their spans, and all spans."""
    found = find_secrets(doc_columns(docs, "doc_id", "text"))
    return found.select(
        "doc_id",
        "secrets.n_assign",
        "secrets.n_access",
        "secrets.n_hex",
        F.sha2("secrets.base_spans", 256).alias("base_sha256"),
        "secrets.spans",
    )
