"""Plain versions of the corpus operators, for small tables, written without the library."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import accumulate

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text: str | None) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def fold(doc_id: int | None, modulus: int, remainder: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == remainder


# 1: base score and context-tree weighting

def base_scores(rows):
    train = [t for i, t in rows if not fold(i, 7, 2)]
    counts = Counter()
    for text in train:
        counts.update([*words(lower(text)), None])
    total, distinct = sum(counts.values()), len(counts) + 1
    out = []
    for i, text in rows:
        tokens = [*words(lower(text)), None]
        score = sum(math.log10((counts[t] + 1) / max(total + distinct, 1)) for t in tokens)
        out.append((i, fold(i, 7, 2), len(tokens), sum(counts[t] > 0 for t in tokens), total, score))
    return out


def tree_scores(rows, depth):
    counts = defaultdict(lambda: [0, 0])

    def decisions(text):
        data = bytes(depth) + (text or "").encode() + b"\xff"
        for i in range(depth, len(data)):
            for k in range(8):
                node = (1 << k) | (data[i] >> (8 - k))
                yield data[i - depth : i], node, (data[i] >> (7 - k)) & 1

    for i, text in rows:
        if not fold(i, 7, 2):
            for context, node, bit in decisions(text):
                for d in range(depth + 1):
                    counts[context[depth - d :], node][bit] += 1
    longer = defaultdict(list)
    for context, node in counts:
        if context:
            longer[context[1:], node].append((context, node))

    def estimate(pair):
        a, b = counts[pair]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    known = {}

    def weighted(pair):
        if pair not in known:
            own = estimate(pair)
            if len(pair[0]) < depth:
                below = sum(weighted(p) for p in longer[pair])
                top = max(own, below)
                own = top + math.log(math.exp(own - top) + math.exp(below - top)) - math.log(2)
            known[pair] = own
        return known[pair]

    def chance(context, node, bit):
        total, rest = 0.0, 1.0
        for d in range(depth + 1):
            pair = (context[depth - d :], node)
            if pair not in counts:
                return total + rest / 2
            own = 1.0 if d == depth else math.exp(estimate(pair) - weighted(pair) - math.log(2))
            a, b = counts[pair]
            total += rest * own * ((b if bit else a) + 0.5) / (a + b + 1)
            rest *= 1 - own
        return total

    return [(i, sum(math.log10(chance(*d)) for d in decisions(text))) for i, text in rows]


# 2: near-duplicates

def shingles(text):
    w = words(lower(text))
    if len(w) >= 5:
        return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    return frozenset([tuple(w)] if w else [])


def near_duplicates(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, (i, x) in enumerate(sets):
        for b, (j, y) in enumerate(sets[:a]):
            if i is not None and j is not None and x and y:
                n = len(x & y)
                if 100 * n >= 75 * (len(x) + len(y) - n):
                    parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    out = []
    for k, (i, s) in enumerate(sets):
        component = None if i is None else least[find(k)]
        out.append((i, len(s), component, component == i))
    return out


# 5 and 6: repeated strings

def suffix_dedup(rows, length=400):
    texts = [(i, (t or "").encode()) for i, t in rows]
    counts = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if counts[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        kept = bytes(v for v, g in zip(t, gone, strict=True) if not g)
        spans = bytes(gone).count(b"\0\1") + (gone[:1] == b"\1")
        out.append((i, len(t), sum(gone), spans, sha(kept)))
    return out


def substring_dedup(rows, size=13):
    lists = [(i, words(t)) for i, t in rows]
    first = {}
    for i, w in lists:
        for k in range(len(w) - size + 1):
            if i is not None:
                key = tuple(w[k : k + size])
                first[key] = min(i, first.get(key, i))
    out = []
    for i, w in lists:
        gone = bytearray(len(w))
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = b"\1" * size
        kept = " ".join(v for v, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), sha(kept)))
    return out


# 7: base measures

def quality(rows):
    out = []
    for i, text in rows:
        text, w = text or "", words(text)
        lines = [x for x in text.split("\n") if words(x)]
        grams = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        counts, again = Counter(grams), set()
        for k, gram in enumerate(grams):
            if counts[gram] > 1:
                again.update(range(k, k + 5))
        failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
        symbols = sum(c in "#*$%&|<>" for c in text)
        out.append((i, len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again), failed))
    return out


# 8: greedy string tiling

def benchmark_words(text):
    edge = r"[!-/:-@\[-`{-~]+"
    trimmed = (re.sub(f"^{edge}|{edge}$", "", w) for w in words(lower(text)))
    return [w for w in trimmed if w]


def tiles(item, text, least=5):
    taken, marked, covered, n = [0] * len(item), [0] * len(text), 0, 0
    for size in range(len(item), least - 1, -1):
        for j in range(len(text) - size + 1):
            if any(marked[j : j + size]):
                continue
            for i in range(len(item) - size + 1):
                if not any(taken[i : i + size]) and item[i : i + size] == text[j : j + size]:
                    taken[i : i + size] = marked[j : j + size] = [1] * size
                    covered, n = covered + size, n + 1
                    break
    return covered, n


def contaminated(docs, items, coverage=0.5):
    best = {}
    words_of = [(j, benchmark_words(item)) for j, item in items]
    for i, text in docs:
        t = benchmark_words(text)
        runs = {tuple(t[k : k + 5]) for k in range(len(t) - 4)}
        for j, w in words_of:
            # Without a common run of five words there is no tile.
            if i is None or j is None or not any(tuple(w[k : k + 5]) in runs for k in range(len(w) - 4)):
                continue
            covered, n = tiles(w, t)
            if covered >= coverage * len(w):
                found = (covered / len(w), len(w), covered, n)
                best[i, j] = max(found, best.get((i, j), found))
    return sorted((i, j, *found) for (i, j), found in best.items())


# 3: maximal segments

def segments(scores):
    def split(low, high):
        best = None
        for a in range(low, high):
            total = 0.0
            for b in range(a, high):
                total += scores[b]
                longer = best and abs(total - best[0]) <= 1e-9 and b - a < best[2] - best[1]
                if total > 1e-9 and (best is None or total > best[0] + 1e-9 or longer):
                    best = (total, a, b)
        if best:
            yield from split(low, best[1])
            yield best[1], best[2]
            yield from split(best[2] + 1, high)

    return list(split(0, len(scores)))


# 11: secrets

def base_secrets(text):
    """Kind, start and end of the base findings, letter by letter where that is simple."""
    text = text or ""
    out = []
    names = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in n) for n in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    at = 0
    form = re.compile(rf"""(?:{names})["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""")
    while found := form.search(text, at):
        at = found.end()
        if len(found[1]) >= 8:
            out.append(("assign", found.start(), found.end()))
    for kind, form, least in (("access", r"AKIA[A-Z0-9]+", 16), ("hex", r"[0-9a-f]+", 32)):
        out += [(kind, *m.span()) for m in re.finditer(form, text) if len(m[0]) >= least]
    return sorted(out, key=lambda f: (f[1], ["assign", "access", "hex"].index(f[0])))


def guess_bits(value, ranks, op, repeats=True):
    """Cheapest cut of a value by trying every segment at every place."""
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t)

    def walk(i, j):
        keys = [op._SHIFTED.get(c, c) for c in lower(value[i:j])]
        shift = [a != b for a, b in zip(value[i:j], keys)]
        for direction, first, turn in op.WALKS:
            ways = [direction(a, b) for a, b in zip(keys, keys[1:])]
            if j - i >= 3 and None not in ways:
                turns = 1 + sum(a != b for a, b in zip(ways, ways[1:]))
                changes = shift[0] + sum(a != b for a, b in zip(shift, shift[1:]))
                yield first + turns * turn + len(ways) * op.STRAIGHT_BITS + changes

    def segment(i, j):
        part = value[i:j]
        yield sum(map(op.sign_bits, part))
        yield from walk(i, j)
        if 3 <= len(part) <= op.LONGEST_WORD:
            word, plain = lower(part), lower(part).translate(op._LEET)
            if word in ranks:
                yield math.log2(ranks[word]) + op.case_bits(part)
            elif plain in ranks:
                yield math.log2(ranks[plain]) + op.case_bits(part) + sum(a != b for a, b in zip(word, plain))
        yield from (bits for end, bits in op.dates(value, i) if end == j)
        for p in range(1, op.LONGEST_UNIT + 1) if repeats else ():
            n = 1
            while value[i + n * p : i + n * p + p] == value[i : i + p] and len(value[i : i + p]) == p:
                n += 1
            if i + n * p == j and n >= (3 if p == 1 else 2):
                yield guess_bits(value[i : i + p], ranks, op, False) + math.log2(n)

    best = [0.0]
    for j in range(1, len(value) + 1):
        best.append(min(best[i] + math.log2(5) + bits for i in range(j) for bits in segment(i, j)))
    return best[-1]


# 12: alignment

def alignment(rows, ids_a, ids_b, bytes_a, bytes_b):
    """Rows of the query from two functions that give a text's ids and two that give an id's bytes."""
    seen, count = [], Counter()
    for i, text in rows:
        a, b = (ids_a(" " + text), ids_b(text)) if text else ([], [])
        if text and not (b"".join(map(bytes_a, a)) == b"".join(map(bytes_b, b)) == (" " + text).encode()):
            a, b = [], []
        spans = []
        for ids, size in ((a, bytes_a), (b, bytes_b)):
            end = list(accumulate(len(size(k)) for k in ids))
            spans.append([(e - len(size(k)), e, k) for e, k in zip(end, ids)])
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups = [[[], []] for _ in cuts]
        for which, side in enumerate(spans):
            at = 0
            for _, e, k in side:
                groups[at][which].append(k)
                at += e == cuts[at]
        links = [(x, y) for s, e, x in spans[0] for t, u, y in spans[1] if s < u and t < e] if len(text or "") < 3000 else _links(*spans)
        count.update(set(links))
        said = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        seen.append((i, len(a), len(b), len(groups), links, sha(said) if a else ""))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    return [
        (i, n_a, n_b, n_g, len(links), sum(count[k] == most[k[0]] for k in links), sum(count[k] for k in links), digest)
        for i, n_a, n_b, n_g, links, digest in seen
    ]


def _links(a, b):
    """Overlapping tokens of two tilings, walking both."""
    i = j = 0
    out = []
    while i < len(a) and j < len(b):
        out.append((a[i][2], b[j][2]))
        i, j = i + (a[i][1] <= b[j][1]), j + (b[j][1] <= a[i][1])
    return out


# 13: collocations

def collocations(rows, least=100, top=2000, longest=5):
    """Rows of the query from ``(lang, text)``."""
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            count.update((lang, *w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    frequent = {p: n for p, n in count.items() if n >= least}
    inside = defaultdict(int)
    for p, n in frequent.items():
        for k in range(2, len(p) - 1):
            for i in range(1, len(p) - k + 1):
                key = (p[0], *p[i : i + k])
                inside[key] = max(inside[key], n)
    found = defaultdict(list)
    for (lang, *w), a in frequent.items():
        if len(w) < 2 or inside[lang, *w] >= a:
            continue
        n = total[lang]
        cuts = [(1000 * a * n // (count[lang, *w[:k]] * count[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(w).encode(), count[lang, *w[:k]], count[lang, *w[k:]], n))
    return [
        (lang, rank, p.decode(), -a, l, r, n, -score)
        for lang in sorted(found)
        for rank, (score, a, p, l, r, n) in enumerate(sorted(found[lang])[:top], 1)
    ]


# 3: the whole query: log-odds, calibration, curve

def toxicity(rows, labels, drift=0.5, prior_share=0.01, chance=0.05, low=-8.0, high=60.0):
    """``doc_id, held_out, score`` from ``(doc_id, text)`` and ``{doc_id: toxic}``."""
    tokens = {i: benchmark_words(t) for i, t in rows}
    seen, train = set(), []
    for i, text in sorted(rows, key=lambda r: r[0]):
        if i in labels and not fold(i, 3, 1) and (text, labels[i]) not in seen:
            seen.add((text, labels[i]))
            train.append(i)
    counts = {y: Counter(w for i in train if labels[i] == y for w in tokens[i]) for y in (0, 1)}
    total = {y: sum(counts[y].values()) for y in (0, 1)}
    prior = prior_share * (total[0] + total[1])
    gain = {}
    for w in {*counts[0], *counts[1]}:
        own = prior * (counts[0][w] + counts[1][w]) / (total[0] + total[1])
        odds = [math.log((counts[y][w] + own) / (total[y] + prior - counts[y][w] - own)) for y in (0, 1)]
        delta = odds[1] - odds[0]
        width = math.sqrt(1 / (counts[1][w] + own) + 1 / (counts[0][w] + own))
        gain[w] = max(0.0, delta - width) + min(0.0, delta + width) - drift
    share = {w: counts[0][w] / total[0] for w in gain if gain[w] != -drift}
    rest = 1 - sum(share.values())

    def moment(r):
        return sum(p * math.exp(min(r * gain[w], 700)) for w, p in share.items()) + rest * math.exp(-r * drift)

    below, above = 1e-3, 1e-3
    while moment(above) < 1 and above < 64:
        below, above = above, above * 2
    for _ in range(60):
        mid = (below + above) / 2
        below, above = (mid, above) if moment(mid) < 1 else (below, mid)
    decay = below
    found = {}
    for i, own in tokens.items():
        scores = [gain.get(w, -drift) for w in own]
        found[i] = [sum(scores[a : b + 1]) for a, b in segments(scores)]
    clean = [i for i in train if labels[i] == 0]
    tops = sorted(decay * max(found[i]) - math.log(max(len(tokens[i]), 1)) for i in clean if found[i])
    level = max(0.0, 1 - chance * len(clean) / len(tops)) if tops else 0.0
    log_k = tops[max(math.ceil(level * len(tops)) - 1, 0)] + math.log(-math.log(1 - chance)) if tops else 0.0
    evidence = {}
    for i, own in found.items():
        normal = [decay * s - log_k - math.log(max(len(tokens[i]), 1)) for s in own]
        held = [v for v in normal if v >= -math.log(chance)]
        value = sum(held) if held else max(normal, default=low)
        evidence[i] = max(low, min(high, value))
    bins = defaultdict(lambda: [0, 0])
    for i in train:
        bins[math.copysign(math.floor(abs(evidence[i] * 4) + 0.5), evidence[i]) / 4][labels[i]] += 1
    n1, n0 = sum(b[1] for b in bins.values()), sum(b[0] for b in bins.values())
    goals = (1 / (n0 + 2), (n1 + 1) / (n1 + 2))

    def loss(a, b):
        out = 1e-6 * a * a
        for x, n in bins.items():
            z = a * x + b
            out += sum(n) * (max(z, 0) + math.log1p(math.exp(-abs(z)))) - z * (n[1] * goals[1] + n[0] * goals[0])
        return out

    a, b, step = 0.0, math.log((n1 + 1) / (n0 + 1)), 1.0
    while step > 1e-9:  # pattern search: no derivative to get wrong
        here = loss(a, b)
        tries = [(a + i * step, b + j * step) for i in (-1, 0, 1) for j in (-1, 0, 1)]
        best = min(tries, key=lambda p: loss(*p))
        a, b, step = (*best, step) if loss(*best) < here else (a, b, step / 2)
    return [(i, fold(i, 3, 1), 1 / (1 + math.exp(-(a * evidence[i] + b)))) for i, _ in rows]


# 10: vectors, machines and votes

def letter_runs(text, cells=4096):
    """Shares of the hashed letter runs of one to four bytes, square-rooted."""
    words_of = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not words_of:
        return None
    raw = (" " + " ".join(words_of) + " ").encode("utf-8", "replace")
    full, counts = 2**64 - 1, Counter()
    for n in (1, 2, 3, 4):
        for k in range(len(raw) - n + 1):
            v = int.from_bytes(raw[k : k + n], "big") + (n << 40)
            v ^= v >> 33
            v = v * 0xFF51AFD7ED558CCD & full
            v ^= v >> 33
            v = v * 0xC4CEB9FE1A85EC53 & full
            v ^= v >> 33
            counts[v >> 52] += 1
    total = sum(counts.values())
    return [math.sqrt(counts[c] / total) for c in range(cells)]


def language(text, families, pairs, weights, sharpness=4.0):
    """Predicted language and score of one text from the machines' weights, offset last."""
    x = letter_runs(text)
    if x is None:
        return "und", 0.0
    value = [sum(a * b for a, b in zip(w, x)) + w[-1] for w in weights]
    ranks = value[: len(families)]
    family = ranks.index(max(ranks))
    chance = 1 / sum(math.exp(sharpness * (v - max(ranks))) for v in ranks)
    votes, sure = Counter(), {c: 1.0 for c in families[family]}
    for (f, a, b), v in zip(pairs, value[len(families) :]):
        if f == family:
            p = 1 / (1 + math.exp(-sharpness * v))
            votes[a if p >= 0.5 else b] += 1
            sure[a], sure[b] = min(sure[a], p), min(sure[b], 1 - p)
    lang = max(families[family], key=lambda c: (votes[c], sure[c]))
    return lang, min(1.0, chance * sure[lang])
