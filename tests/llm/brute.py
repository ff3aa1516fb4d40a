"""The operators' results worked out plainly, one document after the other."""

from __future__ import annotations

import re
import zlib

import numpy as np
from tokenizers import Tokenizer

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

WORDS = "the quick brown fox jumps over a lazy dog while seven wizards mix potent jars of ink".split()
LONG = " ".join(f"{WORDS[i % 17]}{i % 101}" for i in range(30_000))
#: doc_id, text, lang, source: nulls, empty and very long texts, ties and repeated rows.
ROWS = [
    (1, "Hello World", "en", "a"),
    (2, "hello world", "en", "a"),
    (2, "hello world", "en", "a"),
    (3, None, "en", None),
    (4, "", None, "b"),
    (5, " \n\t ", "en", "b"),
    (6, LONG, "en", "b"),
    (7, LONG + " end", "en", "c"),
    (8, LONG.upper(), "de", "c"),
    (9, "Äpfel und Öl", "de", ""),
    (9, "äpfel und öl", "de", ""),
    (10, " ".join(f"w{i}" for i in range(200)), "xx", "d"),
    (11, " ".join(f"w{i}" for i in range(1, 201)), "xx", "d"),
    (12, "日本語のテキスト。😀 é a\xa0b", "ja", "d"),
]
TABLE = "doc_id bigint, text string, lang string, source string"


def lower(text):
    return (text or "").translate(LOWER)


def shingles(text, words):
    found = WORD.findall(lower(text))
    if len(found) < words:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + words]) for i in range(len(found) - words + 1))


def components(docs, words, percent):
    """doc_id to the smallest doc_id that links reach; ``docs`` holds (doc_id, text)."""
    sets = [(doc, shingles(text, words)) for doc, text in docs]
    root = {doc: doc for doc, _ in docs}

    def find(doc):
        while root[doc] != doc:
            doc = root[doc]
        return doc

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            both = len(x & y)
            if both and 100 * both >= percent * (len(x) + len(y) - both):
                low, high = sorted([find(a), find(b)])
                root[high] = low
    return {doc: find(doc) for doc, _ in docs}


def token_ids(texts, path, end):
    tokenizer = Tokenizer.from_file(path)
    found = tokenizer.encode_batch([text or "" for text in texts], add_special_tokens=False)
    return [np.array([*x.ids, end], "<u4") for x in found]


def checksum(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
