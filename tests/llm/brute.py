"""Plain versions of the operators, for small tables: rows are (doc_id, text)."""

import hashlib
import re
from collections import Counter, defaultdict
from math import ceil

ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def low(text):
    return (text or "").translate(LOWER)


def contamination(rows, items, window=13):
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall(low(text))
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i:i + n])].add(str(item))
    sizes = sorted({len(x) for x in windows})
    out = []
    for doc, text in rows:
        w = ALNUM.findall(low(text))
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= x
        out.append((doc, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit) and 20 * len(hit) >= len(w)))
    return out


def substrings(rows, window=35):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        out.append((doc, len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def shingle_set(text, size):
    w = WORD.findall(low(text))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + size]) for i in range(len(w) - size + 1)}


def components(rows, size=4, percent=85):
    sets = [shingle_set(t, size) for _, t in rows]
    index = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
    both = Counter((a, b) for v in index.values() for k, a in enumerate(v) for b in v[k + 1:])
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least.get(find(i)), links[i]) for i, (doc, _) in enumerate(rows)]


def lines(rows, min_docs=10):
    key = lambda x: low(x.strip(" \t\n\x0b\x0c\r"))
    docs = defaultdict(set)
    for doc, text in rows:
        for x in (text or "").split("\n"):
            docs[key(x)].add(doc)
    often = {k for k, v in docs.items() if k and len(v) >= min_docs}
    out = []
    for doc, text in rows:
        all_ = (text or "").split("\n")
        kept = [x for x in all_ if key(x) not in often]
        out.append((doc, len(all_), len(all_) - len(kept), "\n".join(kept)))
    return out


def prefix_length(n, percent):
    return n - ceil(percent * n / 100) + 1


def aligned(text, a, b):
    """(A ids, B ids, groups as (A ids, B ids)) by the libraries, and sets of ends."""
    from itertools import accumulate

    letters = {c: i for i, c in enumerate(byte_letters())}
    if not text:
        return [], [], []
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
    raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
        return [], [], []
    ends_a, ends_b = ([0, *accumulate(map(len, x))] for x in (raw_a, raw_b))
    place_a, place_b = ({e: i for i, e in enumerate(x)} for x in (ends_a, ends_b))
    cuts = sorted(set(ends_a) & set(ends_b))
    return ids_a, ids_b, [(ids_a[place_a[x]:place_a[y]], ids_b[place_b[x]:place_b[y]]) for x, y in zip(cuts, cuts[1:])]


def byte_letters():
    seen = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE]
    return [chr(b) if b in seen else chr(0x100 + sum(x not in seen for x in range(b))) for b in range(256)]


def alignment(rows, path_a, path_b):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b)
    a.encode_special_tokens = True
    found = [(doc, *aligned(text, a, b)) for doc, text in rows]
    count = Counter((x[-1], y[-1]) for _, _, _, groups in found for x, y in groups)
    best = Counter()
    for (_, y), n in count.items():
        best[y] = max(best[y], n)
    out = []
    for doc, ids_a, ids_b, groups in found:
        links = [(x[-1], y[-1]) for x, y in groups]
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((doc, len(ids_a), len(ids_b), len(groups), len(links), sum(count[k] == best[k[1]] for k in links),
                    sum(count[k] for k in links), sha(text) if text else ""))
    return out


def ranked(rows, items, top=50):
    from math import floor, log

    docs = [(d, Counter(ALNUM.findall(low(t)))) for d, t in rows]
    docs = [(d, c, sum(c.values())) for d, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    terms = defaultdict(set)
    for item, text in items:
        terms[item].update(ALNUM.findall(low(text)))
    out = []
    for item, asked in terms.items():
        found = []
        for d, c, n in docs:
            m = 50 + (50 * n * n_docs) // n_terms
            score = sum(floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10 ** 9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in asked if t in c)
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(found, key=lambda x: x[:3])[:top])]
    return out
