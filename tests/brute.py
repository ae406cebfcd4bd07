"""Plain-Python versions of the results, for small inputs."""

from __future__ import annotations

import math
from collections import defaultdict
from fractions import Fraction
from itertools import combinations


def similar_pairs(rows, threshold):
    sets = defaultdict(set)
    for item, member in rows:
        sets[item].add(member)
    found = {}
    for a, b in combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        similarity = common / len(sets[a] | sets[b])
        if common and similarity >= threshold:
            found[a, b] = similarity
    return found


def bucket_pairs(rows, bands, per_band):
    sets = defaultdict(set)
    for item, member in rows:
        sets[item].add(member)
    codes = {m: i for i, m in enumerate(sorted({m for _, m in rows}))}
    buckets = defaultdict(set)
    for item, members in sets.items():
        signature = [min((h * codes[m] + 1) % len(codes) for m in members) for h in range(bands * per_band)]
        for band in range(bands):
            buckets[band, tuple(signature[band * per_band:(band + 1) * per_band])].add(item)
    return {pair for items in buckets.values() for pair in combinations(sorted(items), 2)}


class Ratings:
    """Whole-number ratings ``(user, item, stars)``, the last of several for one pair being the latest."""

    def __init__(self, rows):
        self.rating, self.by_user, self.by_item = {}, defaultdict(dict), defaultdict(dict)
        raw_user, raw_item = defaultdict(list), defaultdict(list)
        for u, i, r in rows:
            self.rating[u, i] = r
            raw_user[u].append(r)
            raw_item[i].append(r)
        for (u, i), r in self.rating.items():
            self.by_user[u][i] = r
            self.by_item[i][u] = r
        self.user_avg = {u: Fraction(sum(x), len(x)) for u, x in raw_user.items()}
        self.item_avg = {i: Fraction(sum(x), len(x)) for i, x in raw_item.items()}

    def similarity(self, a, b, mode="common", min_common=None):
        common = self.by_item[a].keys() & self.by_item[b].keys()
        pa, pb = self.item_avg[a], self.item_avg[b]
        if not common:
            return float(min(pa, pb) / max(pa, pb))
        users, vote = common, {}
        if mode == "default_voting":
            users = self.by_item[a].keys() | self.by_item[b].keys()
            vote = {x: Fraction(sum(self.by_item[x][u] for u in common), len(common)) for x in (a, b)}
        devs = [(self.by_item[a].get(u, vote.get(a)) - pa, self.by_item[b].get(u, vote.get(b)) - pb) for u in users]
        top = sum(x * y for x, y in devs)
        if top == 0:
            return 0.0
        s = float(top) / (math.sqrt(sum(x * x for x, _ in devs)) * math.sqrt(sum(y * y for _, y in devs)))
        return s / 2 if min_common and len(common) < min_common else s

    def predict(self, u, i, rho=2.5, k=None, **options):
        known_user, known_item = u in self.by_user, i in self.by_item
        if not known_user:
            return float(self.item_avg[i]) if known_item else 2.5
        if not known_item:
            return float(self.user_avg[u])
        if (u, i) in self.rating:
            return float(self.rating[u, i])
        sims = sorted(((self.similarity(i, j, **options), j) for j in self.by_user[u]), key=lambda x: (-x[0], x[1]))
        used = [(s ** rho, self.by_user[u][j]) for s, j in sims if s > 0][:k]
        if not used:
            return float((self.item_avg[i] + self.user_avg[u]) / 2)
        return min(5.0, sum(w * r for w, r in used) / sum(w for w, _ in used))
