"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re
import zlib
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def held_out(doc_id, folds):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds == 0


def windows_removed(rows, window=13):
    """rows: (doc_id, text) -> per row (n_words, n_removed, sha256 of what is kept)."""
    big = 2**63 - 1
    least = {}
    split = [(big if i is None else i, WORD.findall(t or "")) for i, t in rows]
    for d, w in split:
        for k in range(len(w) - window + 1):
            x = tuple(w[k:k + window])
            least[x] = min(least.get(x, big + 1), d)
    out = []
    for d, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if least[tuple(w[k:k + window])] < d:
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def ascii_lower(t):
    return t.encode().lower().decode()


def shingles(text, n=5):
    w = WORD.findall((text or "").lower())
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def jaccard_classes(rows, n=5):
    """rows: (doc_id, text) -> per row (class id, links to other rows)."""
    sets = [shingles(t, n) for _, t in rows]
    index = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            index[x].append(i)
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    links = [0] * len(rows)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in index[x]:
                common[j] += 1
        for j, c in common.items():
            if j != i and 9 * c >= 4 * (len(s) + len(sets[j])):
                links[i] += 1
                up[max(root(i), root(j))] = min(root(i), root(j))
    # equal rows without words are one document
    blank = {}
    for i, (d, t) in enumerate(rows):
        if not sets[i]:
            j = blank.setdefault((d, t), i)
            up[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        ids[root(i)].append(d)
    return [(min((d for d in ids[root(i)] if d is not None), default=None), links[i]) for i in range(len(rows))]


def lines_kept(rows, num=4, den=5):
    """rows: (doc_id, text), distinct -> text of each row without repeated lines."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    seen, out = [], [None] * len(rows)
    for i in order:
        if rows[i][1] is None:
            continue
        kept = []
        for line in rows[i][1].split("\n"):
            s = set(WORD.findall(line))
            if not s:
                kept.append(line)
                continue
            if not any(len(s & t) * (num + den) >= num * (len(s) + len(t)) for t in seen):
                kept.append(line)
            seen.append(s)
        out[i] = "\n".join(kept)
    return out


def phrases(rows, least=10, top=2000, share=50):
    """rows: (text, lang) -> the collocation report as tuples."""
    counts, words = defaultdict(int), defaultdict(int)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", ascii_lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    counts[lang, tuple(w[i:i + k])] += 1
    found = {x: a for x, a in counts.items() if len(x[1]) > 1 and a >= least}
    by_lang = defaultdict(list)
    for (lang, p), a in found.items():
        score, _, left, right = min((10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k, counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p)))
        around = [f for (lg, q), f in found.items() if lg == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
        if not any(100 * f >= share * a for f in around):
            by_lang[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return [(lang, i, p.decode(), -a, left, right, words[lang], -s)
            for lang, xs in by_lang.items() for i, (s, a, p, left, right) in enumerate(sorted(xs)[:top], 1)]


def damaged(rows):
    """rows: (conv_id, turn, role, text) -> {conv_id: rows after damage, in order}."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        out[conv] += [] if k == 0 else [(turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text)] * (2 if k == 3 else 1)
    for conv in out:
        out[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def repaired(rows):
    """One conversation's rows (turn, role, text) -> gaps, blank, duplicate,
    truncated, illegal, cost, audit, sha256 of the repaired rows."""
    made = {"": "u", "s": "u", "u": "a", "a": "u"}  # what may be inserted after each last initial
    name = {"u": "user", "a": "assistant"}
    best, seen, faults = {"": (0, "", ())}, set(), defaultdict(int)

    def inserted(best):
        best = dict(best)
        for _ in range(3):
            for s, (c, x, t) in list(best.items()):
                new = (c + 5, x + "I", t + ((name[made[s]], ""),))
                if made[s] not in best or new[:2] < best[made[s]][:2]:
                    best[made[s]] = new
        return best

    for _, role, text in rows:
        last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        more = 5 * (fault == "truncated")
        new = {}

        def offer(s, x):
            if s not in new or x[:2] < new[s][:2]:
                new[s] = x

        for s, (c, x, t) in inserted(best).items():
            offer(s, (c + 2, x + "D", t))
            if fault in ("blank", "duplicate"):
                continue
            offer(made[s], (c + 1 + more, x + "R", t + ((name[made[s]], text),)))
            i = role[:1]
            if i and i in "sua" and s + i in ("s", "u", "su", "ua", "au"):
                offer(i, (c + more, x + "K", t + ((role, text),)))
        best = new
    ends = inserted(best)
    cost, audit, kept = min((ends[s] for s in ("", "a") if s in ends), key=lambda e: e[:2])
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    text = "\n".join(f"{r}:{t}" for r, t in kept)
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def conversations(rows):
    broken = damaged(rows)
    return {conv: repaired(broken.get(conv, [])) for conv in {r[0] for r in rows}}
