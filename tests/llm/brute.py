"""Plain versions of what the operators compute."""

import hashlib
import re
import zlib

import xxhash

ANY_SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def fold(key, folds):
    return zlib.crc32(("" if key is None else str(key)).encode()) % folds


def simhash(text, shingle=4):
    words = ANY_SPACE.findall(lower(text))
    if not words:
        return 0
    spans = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in spans]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, bits):
    """First id of each (id, fingerprint)'s component."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= bits:
                root[max(find(i), find(j))] = min(find(i), find(j))
    smallest = {}
    for i, (key, _) in enumerate(prints):
        r = find(i)
        if key is not None:
            smallest[r] = min(smallest.get(r, key), key)
    return [smallest.get(find(i)) for i in range(len(prints))]


def removed(rows, length=50):
    """(doc_id, bytes, lost bytes, spans, hash of the rest) of (doc_id, text) rows."""
    known = {}
    for key, text in rows:
        data = (text or "").encode()
        for at in range(len(data) - length + 1):
            w = data[at:at + length]
            if key is not None:
                known[w] = min(known.get(w, key), key)
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - length + 1):
            first = known.get(data[at:at + length])
            if first is not None and (key is None or first < key):
                gone[at:at + length] = b"\1" * length
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((key, len(data), sum(gone), spans, sha(bytes(b for b, g in zip(data, gone) if not g))))
    return out


def passages(docs, items, window=10):
    owners = {}
    for item, text in items:
        words = ALNUM.findall(lower(text))
        n = min(window, len(words))
        for at in range(len(words) - n + 1 if n else 0):
            owners.setdefault(tuple(words[at:at + n]), set()).add(item)
    sizes = {len(x) for x in owners}
    out = []
    for key, text in docs:
        words = ALNUM.findall(lower(text))
        hit, found = set(), set()
        for n in sizes:
            for at in range(len(words) - n + 1):
                if got := owners.get(tuple(words[at:at + n])):
                    hit.update(range(at, at + n))
                    found |= got
        found.discard(None)
        names = ",".join(sorted(map(str, found)))
        out.append((key, len(words), len(hit), len(found), sha(names.encode()), bool(hit)))
    return out


def ranked(docs, items, k=20):
    """(item number, rank, doc_id, score) of (doc_id, text) and item texts."""
    import math
    from collections import Counter

    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    bags = [(d, Counter(term.findall(lower(t)))) for d, t in docs]
    n_docs = sum(1 for _, b in bags if b)
    total = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for i, text in enumerate(items):
        asked = Counter(term.findall(lower(text)))
        found = []
        for d, bag in bags:
            m = 75 + 25 * bag.total() * n_docs // total if bag else 0
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m)) for t, times in asked.items() if t in bag
            )
            if score > 0:
                found.append((-score, d is not None, d or 0, d))
        found.sort(key=lambda x: x[:3])
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(found[:k])]
    return out


def aligned(rows):
    """Counts and group texts of (doc_id, text) by whole encodings and one walk along both."""
    from collections import Counter

    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    from docsentinel.llm.packing import byte_alphabet

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    to_byte = {c: x for x, c in byte_alphabet().items()}

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    docs = []
    for doc, text in rows:
        ids_a = a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        parts_a = [bytes(to_byte[c] for c in a.id_to_token(i)) for i in ids_a]
        parts_b = [bytes_b(i) for i in ids_b]
        if not text or not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
            docs.append((doc, 0, 0, [], []))
            continue
        groups, links, i, j, at_a, at_b = [], [], 0, 0, 0, 0
        left_a, left_b = [], []
        while i < len(ids_a) or j < len(ids_b):
            if at_a <= at_b:
                left_a.append(ids_a[i])
                at_a, i = at_a + len(parts_a[i]), i + 1
            else:
                left_b.append(ids_b[j])
                at_b, j = at_b + len(parts_b[j]), j + 1
            if at_a == at_b:
                groups.append((left_a, left_b))
                links.append((left_a[-1], left_b[-1]))
                left_a, left_b = [], []
        docs.append((doc, len(ids_a), len(ids_b), groups, links))
    counts = Counter(x for d in docs for x in d[4])
    most = Counter()
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    out = []
    for doc, n_a, n_b, groups, links in docs:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append((doc, n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
                    sum(counts[x] for x in links), sha(text.encode()) if n_a else "", text))
    return out
