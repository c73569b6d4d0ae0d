"""Plain versions of the operators, for small inputs."""

import re
from collections import defaultdict


def jaccard_components(docs, width=5, percent=80):
    sets = {}
    for d, t in docs:
        low = (t or "").translate({c: c + 32 for c in range(65, 91)})
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets[d] = {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    low = {d: d for d in sets}
    ids, changed = list(sets), True
    links = defaultdict(list)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            o = len(sets[a] & sets[b])
            if o and 100 * o >= percent * len(sets[a] | sets[b]):
                links[a].append(b)
                links[b].append(a)
    while changed:
        changed = False
        for a in ids:
            m = min([low[a], *[low[b] for b in links[a]]])
            changed, low[a] = changed or m != low[a], m
    return {d: (len(sets[d]), low[d]) for d in sets}


def repeated_runs(docs, min_words):
    """doc_id -> (text that stays, number of lines deleted): every line of a run of min_words words or more that stands earlier too.

    Such a run is made of the shortest runs with that many words that begin, or end, at each of its lines.
    """
    seen, spans, gone = {}, [], defaultdict(set)
    for d, t in sorted(docs, key=lambda r: r[0]):
        lines = t.split("\n")
        words = [len(x.encode().split()) for x in lines]
        found = set()
        for step, at in ((1, range(len(lines))), (-1, range(len(lines)))):
            for i in at:
                held, j = 0, i
                while 0 <= j < len(lines):
                    held += words[j]
                    if held >= min_words:
                        found.add((min(i, j), max(i, j)))
                        break
                    j += step
        for i, j in sorted(found):
            run = tuple(lines[i:j + 1])
            spans.append((d, i, j, run))
            seen[run] = min(seen.get(run, (d, i)), (d, i))
    for d, i, j, run in spans:
        if seen[run] < (d, i):
            gone[d].update(range(i, j + 1))
    return {d: ("\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]), len(gone[d])) for d, t in docs}
