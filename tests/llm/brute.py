"""The operators again, one document or pair at a time, for small tables."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter

import public_tokenizers
import tiktoken
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(value):
    return hashlib.sha256(value if isinstance(value, bytes) else value.encode()).hexdigest()


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def fingerprint(text, n=4):
    found = words(ascii_lower(text or ""))
    if not found:
        return 0
    shingles = [" ".join(found[i:i + n]) for i in range(max(1, len(found) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, near):
    """Smallest node reachable, for nodes in ascending order."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def simhash(docs, distance=4):
    prints = {d: fingerprint(t) for d, t in docs.items()}
    found = components(sorted(docs), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= distance)
    return {d: (f"{prints[d]:016x}", found[d]) for d in docs}


def bpe(docs):
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    encoding = tiktoken.Encoding("brute", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {d: encoding.encode_ordinary(t or "") for d, t in docs.items()}
    return {d: (len(i), sha(",".join(map(str, i))), sha((docs[d] or "").encode())) for d, i in ids.items()}


def _kept(gone, symbols):
    return [s for s, g in zip(symbols, gone) if not g]


def substrings(docs, window=13):
    split = {d: words(t) for d, t in docs.items()}
    first = {}
    for d, found in split.items():
        for i in range(len(found) - window + 1):
            key = tuple(found[i:i + window])
            first[key] = min(first.get(key, d), d)
    out = {}
    for d, found in split.items():
        gone = [False] * len(found)
        for i in range(len(found) - window + 1):
            if first[tuple(found[i:i + window])] < d:
                gone[i:i + window] = [True] * window
        out[d] = (len(found), sum(gone), sha(" ".join(_kept(gone, found))))
    return out


def suffixes(docs, length=400):
    raw = {d: (t or "").encode() for d, t in docs.items()}
    counts = Counter(b[i:i + length] for b in raw.values() for i in range(len(b) - length + 1))
    out = {}
    for d, b in raw.items():
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if counts[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        runs = sum(g and not before for g, before in zip(gone, [False, *gone]))
        out[d] = (len(b), sum(gone), runs, sha(bytes(_kept(gone, b))))
    return out


def lines(docs, min_chars=20, min_docs=3):
    split = {d: (t or "").split("\n") for d, t in docs.items()}
    key = {line: ascii_lower(line.strip(" \t\n\x0b\x0c\r")) for found in split.values() for line in found}
    holders = {}
    for d, found in split.items():
        for line in found:
            holders.setdefault(key[line], set()).add(d)
    out = {}
    for d, found in split.items():
        kept = [x for x in found if len(key[x]) < min_chars or len(holders[key[x]]) < min_docs
                or max(holders[key[x]]) == d]
        out[d] = (len(found), len(found) - len(kept), "\n".join(kept))
    return out


def quality(text):
    text = text or ""
    found = words(text)
    windows = Counter(tuple(found[i:i + 5]) for i in range(len(found) - 4))
    repeated = [False] * len(found)
    for i in range(len(found) - 4):
        if windows[tuple(found[i:i + 5])] > 1:
            repeated[i:i + 5] = [True] * 5
    seen, dups = set(), 0
    for line in text.split("\n"):
        if words(line):
            dups += line in seen
            seen.add(line)
    n = len(found)
    return (n, sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), dups, sum(repeated),
            n < 10 or 100 * sum(repeated) > 20 * n)


def url(text):
    if text is None or "://" not in text:
        host = path = ""
    else:
        host, path = re.fullmatch(r"(?s)([^/?#]*)([^?#]*).*", text.split("://", 1)[1]).groups()
    host = ascii_lower(host)
    best = None
    for rule_host, rule_path, verdict in (("net", "/", "block"), ("example.net", "/en/", "allow"),
                                          ("example.com", "/de/", "block"), ("org", "/fr/", "allow")):
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            if best is None or len(rule_host + rule_path) > len(best[0]):
                best = (rule_host + rule_path, verdict)
    return (host, path, *(best or (None, None)))


def alignment(passage, item, match=2, mismatch=-1, gap=-1):
    """Smith-Waterman, cell by cell."""
    above, best = [0] * (len(item) + 1), 0
    for w in passage:
        row = [0]
        for j, v in enumerate(item):
            row.append(max(0, above[j] + (match if w == v else mismatch), above[j + 1] + gap, row[j] + gap))
        best, above = max(best, *row), row
    return best


def leaked(text, item):
    """The score of the best alignment of an item in a text, as a share of its own; both as words."""
    from tagshelf.llm import decontaminate as d
    if not item or sum((Counter(text) & Counter(item)).values()) < d.THRESHOLD * len(item):
        return 0.0
    return d.align(text, item)[0] / (d.MATCH * len(item))


def verdict(text):
    """Whether the vocabularies leave a text alone: tokens by tiktoken, bytes spelt out by sentencepiece itself."""
    import math
    import sentencepiece
    from tagshelf.llm import quality as q
    if "pieces" not in _known:
        _known["pieces"] = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
        with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        _known["tokens"] = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = _known["tokens"].encode_ordinary(text or "")
    if not ids:
        return True
    pieces = _known["pieces"]
    # Line breaks and tabs are bytes to this vocabulary; here all white space counts for nothing.
    solid = re.sub(r"[\x20\x09-\x0D]+", "", text)
    spelt = sum(pieces.is_byte(i) for word in words(text) for i in pieces.encode(word))
    counts = Counter(ids)
    entropy = -sum(n / len(ids) * math.log2(n / len(ids)) for n in counts.values())
    rates = len(text) / len(ids), spelt / max(1, len(solid.encode())), entropy
    return q.fits(q.BANDS[q.main_script(text)], len(ids), rates)


_known = {}
