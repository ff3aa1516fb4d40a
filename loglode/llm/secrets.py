"""Secrets in texts: fixed patterns, and random strings told by how badly a vocabulary packs them."""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator
from functools import cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: A string with fewer characters per token than this looks random; words and names have more.
RATIO = 1.9
#: Kinds of spans in the order in which they stand where they start together.
KINDS = ("assign", "access", "hex", "random")
# Letters of the names in either case, ASCII only.
ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{24}")
#: Fewest characters of a string that is judged.
SHORTEST = 20
STRING = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
UUID = re.compile(r"(?<![0-9A-Za-z])[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Za-z])")
#: Lengths of the digests MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512 in hexadecimal.
DIGESTS = {32, 40, 56, 64, 96, 128}
HEX_PART = re.compile(r"(?<![0-9A-Za-z])(?:0[xX])?([0-9a-f]+|[0-9A-F]+)(?![0-9A-Za-z])")
#: Words, numbers and dates joined by - or _ are identifiers, paths or sentences, not secrets.
IDENTIFIER = re.compile(r"([A-Za-z]+|[0-9]+)([-_/+=]+([A-Za-z]+|[0-9]+))*[-_/+=]*")
LETTERS = re.compile("[A-Za-z]+")
ROWS = "doc_id long, kinds array<string>, starts array<long>, ends array<long>"


@cache
def vocabulary(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def looks_random(string: str, path: str, ratio: float) -> bool:
    """Few characters per token, and neither a known digest nor an identifier.

    A number alone is an identifier, and so are numbers and words joined by signs. A UUID, and
    hexadecimal of the length of a digest, with 0x or without, are taken out wherever signs or the ends
    of the string set them off; what is left is judged if it is still long enough. A word is one token
    or has ``ratio`` characters per token.
    """
    rest = HEX_PART.sub(lambda part: "" if len(part[1]) in DIGESTS else part[0], UUID.sub("", string))
    if not LETTERS.search(rest) or len(rest) < SHORTEST:
        return False
    string = rest
    tokens = vocabulary(path).encode_ordinary
    if len(string) >= ratio * len(tokens(string)):
        return False
    if not IDENTIFIER.fullmatch(string):
        return True
    return any(len(part) < ratio * n for part in LETTERS.findall(string) if (n := len(tokens(part))) > 1)


def spans(text: str, path: str, ratio: float) -> list[tuple[int, int, int]]:
    """start, place of the kind in KINDS and end of each span, in code points, sorted."""
    found = []
    for match in ASSIGN.finditer(text):
        if match.end(1) - match.start(1) >= 6:
            found.append((match.start(), 0, match.end()))
    if "AKIA" in text:
        for match in ACCESS.finditer(text):
            if match.end() - match.start() >= 20:
                found.append((match.start(), 1, match.end()))
    done = 0
    for some in LONG_HEX.finditer(text):
        # The first 24 of a run start where the run does, unless they lie in one already taken.
        if some.start() >= done:
            done = HEX.match(text, some.start()).end()
            found.append((some.start(), 2, done))
    for match in STRING.finditer(text):
        if looks_random(match.group(), path, ratio):
            found.append((match.start(), 3, match.end()))
    return sorted(found)


def scan(path: str, ratio: float) -> Callable:
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, starts, ends = [], [], []
            for text in batch["text"]:
                found = spans(text.as_py() or "", path, ratio)
                kinds.append([KINDS[kind] for _, kind, _ in found])
                starts.append([start for start, _, _ in found])
                ends.append([end for _, _, end in found])
            numbers = pa.list_(pa.int64())
            columns = [
                batch["doc_id"],
                pa.array(kinds, pa.list_(pa.string())),
                pa.array(starts, numbers),
                pa.array(ends, numbers),
            ]
            yield pa.record_batch(columns, ["doc_id", "kinds", "starts", "ends"])

    return of


def find_secrets(docs: DataFrame, path: str = VOCABULARY, ratio: float = RATIO) -> DataFrame:
    """Per row of ``docs``: doc_id and spans, an array of kind, start and end (exclusive).

    Kinds: ``assign``, a value of 6 or more characters given to a name such as password; ``access``,
    an access key of 20 or more; ``hex``, 24 or more hexadecimal digits; and ``random``, a string of
    20 or more characters with under ``ratio`` characters per token. Spans of one kind never overlap,
    those of different kinds may. Positions are code points of the whole text; spans stand by start,
    then kind. A null or empty text has none. Rows that repeat are scanned one by one; an empty table
    gives no rows; other columns are not used. There is no shuffle.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text")
    found = texts.mapInArrow(scan(path, ratio), ROWS)
    zipped = F.arrays_zip(
        F.col("kinds").alias("kind"), F.col("starts").alias("start"), F.col("ends").alias("end")
    )
    return found.select("doc_id", zipped.alias("spans"))
