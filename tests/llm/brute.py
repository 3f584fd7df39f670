"""The contracts of the operators, worked out plainly in Python over a list of rows."""

import array
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text):
    return WORDS.findall(text or "")


def alnum(text):
    return ALNUM.findall(lower(text))


def order(doc_id):
    return (doc_id is None, doc_id or 0)


def tokens(docs, tokenizer):
    """doc_id, n_tokens and crc of each row in order; ties by crc32 of the text."""
    out, at = [], 0
    for d in sorted(docs, key=lambda d: (order(d["doc_id"]), zlib.crc32((d["text"] or "").encode()))):
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids + [2]
        out.append((d["doc_id"], at, len(ids), zlib.crc32(array.array("I", ids).tobytes())))
        at += len(ids)
    return out


def contamination(docs, items):
    windows = defaultdict(set)
    for b in items:
        w = alnum(b["text"])
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add(str(b["item_id"]))
    out = []
    for d in docs:
        w, hit, found = alnum(d["text"]), set(), set()
        for m in {len(k) for k in windows}:
            for i in range(len(w) - m + 1):
                if x := windows.get(tuple(w[i : i + m])):
                    found |= x
                    hit.update(range(i, i + m))
        out.append((d["doc_id"], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def simhash(text):
    w = words(lower(text))
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64)) if hashes else 0


def components(docs):
    """doc_id, fingerprint, component_id of each row."""
    prints = [simhash(d["text"]) for d in docs]
    up = list(range(len(docs)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                up[root(i)] = root(j)
    low = {}
    for i, d in enumerate(docs):
        if d["doc_id"] is not None:
            low[root(i)] = min(low.get(root(i), d["doc_id"]), d["doc_id"])
    return [(d["doc_id"], f"{p:016x}", low.get(root(i))) for i, (d, p) in enumerate(zip(docs, prints))]


def targets(sizes):
    """Target of each source from {source: size}."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        level = (total - sum(3 * sizes[s] for s in full)) / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if 3 * sizes[s] < level * weight[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = words(text)
    grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    seen, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if seen[g] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def warc(pages):
    first, out = {}, []
    for p in sorted(pages, key=lambda p: order(p["page_id"])):
        data = (p["html"] or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        again = digest in first and len(data) >= 100
        out.append((p["page_id"], len(data), digest, "revisit" if again else "response", first[digest] if again else None))
        first.setdefault(digest, p["page_id"])
    return out


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def licenses(text):
    w, places = alnum(text), []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def substrings(docs):
    first = {}
    for d in sorted(docs, key=lambda d: order(d["doc_id"])):
        w = words(d["text"])
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), order(d["doc_id"]))
    out = []
    for d in docs:
        w, gone = words(d["text"]), set()
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < order(d["doc_id"]):
                gone.update(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d["doc_id"], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def base_scores(docs):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score."""
    end, counts = object(), Counter()
    rows = [(d["doc_id"], words(lower(d["text"])) + [end]) for d in docs]
    for doc_id, t in rows:
        if not held_out(doc_id):
            counts.update(t)
    n, v = sum(counts.values()), len(counts)
    return [(i, held_out(i), len(t), sum(counts[x] > 0 for x in t), n, sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)) for i, t in rows]


def shards(docs):
    """doc_id, size, text_crc32 of each row."""
    return [(d["doc_id"], len((d["text"] or "").encode()) + 1, zlib.crc32((d["text"] or "").encode())) for d in docs]


def lattice_scores(docs, model):
    """doc_id and the log10 probability of each text: every way to cut every word into pieces, added up piece by piece."""
    import functools

    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    data = lambda i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).encode()
    usable = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    counts, ends = Counter(), 0
    for d in docs:
        if not held_out(d["doc_id"]):
            ends += 1
            for w in words(lower(d["text"])):
                counts.update(sp.encode(w))
    weight = defaultdict(float)
    for i in usable:
        weight[data(i)] += counts[i] + 0.1
    total = math.fsum(weight.values()) + ends + 0.1
    longest = max(map(len, weight))

    @functools.cache
    def word(text):
        # shares of the paths into each place, scaled down step by step so that long words don't vanish
        s, into, log = "▁".encode() + text, {0: 1.0}, 0.0
        for i in range(len(s)):
            here = into.pop(i, 0.0)
            for k in range(1, min(longest, len(s) - i) + 1):
                if s[i : i + k] in weight:
                    into[i + k] = into.get(i + k, 0.0) + here * weight[s[i : i + k]] / total
            top = max(into.values())
            into, log = {k: v / top for k, v in into.items()}, log + math.log10(top)
        return log + math.log10(into[len(s)])

    return [(d["doc_id"], math.fsum(word(w.encode()) for w in words(lower(d["text"]))) + math.log10((ends + 0.1) / total)) for d in docs]
