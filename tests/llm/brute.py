"""Plain versions of the contracts, for small tables: Python objects, no hashing, no Spark."""

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def op1(rows):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, out = 0, []
    for d, text in sorted(rows, key=lambda r: r[0]):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def op2(rows):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = []
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((d, len(ids), sha(",".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))))
    return sorted(out)


def shingles(text, n):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(lower)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def op5(rows, n=3, percent=85):
    sets = {d: shingles(t, n) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    has = defaultdict(list)
    for d in sorted(sets):
        shared = Counter(e for s in sets[d] for e in has[s])
        for e, k in shared.items():
            if 100 * k >= percent * (len(sets[d]) + len(sets[e]) - k):
                a, b = sorted((find(d), find(e)))
                root[b] = a
        for s in sets[d]:
            has[s].append(d)
    return sorted((d, len(s), find(d), find(d) == d) for d, s in sets.items())


def op7(rows, n=13):
    first = {}
    w = {d: words(t) for d, t in rows}
    for d in sorted(w):
        for i in range(len(w[d]) - n + 1):
            first.setdefault(tuple(w[d][i : i + n]), d)
    out = []
    for d, x in w.items():
        gone = set()
        for i in range(len(x) - n + 1):
            if first[tuple(x[i : i + n])] < d:
                gone.update(range(i, i + n))
        out.append((d, len(x), len(gone), sha(" ".join(y for i, y in enumerate(x) if i not in gone))))
    return sorted(out)


def op9(rows):
    first = {}
    for p, html in rows:
        first[html or ""] = min(p, first.get(html or "", p))
    out = []
    for p, html in rows:
        data, f = (html or "").encode(), first[html or ""]
        out.append((p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if f == p else "revisit", None if f == p else f))
    return sorted(out)


def op10(rows):
    out = []
    for d, text in rows:
        w = words(text)
        seen = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        cover = {j for i in range(len(w) - 4) if seen[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in (text or "").split("\n") if words(x)]
        out.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(cover), len(w) < 10 or 100 * len(cover) > 20 * len(w)))
    return sorted(out)


def op11(rows):
    """rows (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append(((turn is not None, turn or 0, key), role, text))
    turns = {c: [(r, t) for _, r, t in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = [*turns.get(c - int(np.fmod(c, 5)), [])[:h], *own[h:]]
    node = defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            node[tuple(t[:d])].append(c)
    children = defaultdict(set)
    for k in node:
        if k:
            children[k[:-1]].add(k)
    leaves, saved = {}, {}
    for k in sorted(node, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) if children[k] else 1
        saved[k] = sum(saved[x] for x in children[k]) + (len(node[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
    return [(min(v), len(k), min(node[k[:-1]]) if k else None, len(v), len(children[k]), leaves[k], saved[k], sha(",".join(str(c) for c in sorted(v) if len(whole[c]) == len(k)))) for k, v in node.items()]


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def op13(rows):
    """Base spans alone."""
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    out = []
    for d, text in rows:
        found = [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if ok(m[0])] for k, (p, ok) in kinds.items()]
        out.append((d, *map(len, found), sha(",".join(x for f in found for x in f))))
    return out


def op12_words(rows):
    n = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def op12(rows):
    n = op12_words(rows)
    has, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            has[w[:i] + "?" + w[i + 1 :]].add(w)
            if (shorter := w[:i] + w[i + 1 :]) in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for some in has.values():
        for w in some:
            near[w] |= some - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return [(w, form[w], root(w), k, len(near[w]), n[form[w]] if form[w] else None) for w, k in n.items()]
