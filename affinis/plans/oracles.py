"""The registered queries in SQL, over the same tables."""

from __future__ import annotations

import random

from affinis.operators.features import (COMPLIMENT_FEATURES, HYBRID_FEATURES, ITEM_FEATURES, MISSING, MODEL_FEATURES,
                                        USER_FEATURES)
from affinis.operators.jaccard import MERSENNE_31
from affinis.plans.queries import BOOSTED, STUMPS, UNIVERSAL
from affinis.plans.tables import BROKEN, COLD_ITEMS, COLD_USERS, TEST_ORDERS


def _fraction(seed: str, *columns: str) -> str:
    key = ", ".join([f"'{seed}'", *[f"CAST({c} AS VARCHAR)" for c in columns]])
    return f"(CAST(concat('0x', substr(md5(concat_ws('|', {key})), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE)"


def _compliments() -> str:
    kinds = [x for x in COMPLIMENT_FEATURES if x not in ("funny", "cool")]
    parts = [f"count(*) FILTER (WHERE l_returnflag = '{flag}') AS {x}" for x, flag in (("funny", "A"), ("cool", "N"))]
    parts += [f"count(*) FILTER (WHERE p_size % {len(kinds)} = {i}) AS {x}" for i, x in enumerate(kinds)]
    return ", ".join(parts)


PROFILE = """((200 * sum(stars)::BIGINT + count(*)) // (2 * count(*))) / 100.0::DOUBLE AS average_stars,
    count(*) AS review_count, count(DISTINCT sk) AS useful, count(DISTINCT ok) AS fans"""

# Each entry may use the earlier ones.
CTES = {
    "ratings": """SELECT o_custkey AS user_id, l_partkey AS item_id,
        CAST(least(5, ceil(l_quantity / 10)) AS BIGINT) AS stars,
        l_orderkey AS ok, l_linenumber AS ln, l_suppkey AS sk, l_returnflag
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "marked": f"""SELECT *, {_fraction('order', 'ok')} < {TEST_ORDERS} OR {_fraction('user', 'user_id')} < {COLD_USERS}
        OR {_fraction('item', 'item_id')} < {COLD_ITEMS} AS held_out FROM ratings""",
    "train": "SELECT * FROM marked WHERE NOT held_out",
    "test": """SELECT user_id, item_id, arg_max(stars, (ok, ln, sk, stars)) AS stars
        FROM marked WHERE held_out GROUP BY 1, 2""",
    "users": f"""SELECT user_id, {PROFILE} FROM ratings
        WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1""",
    "hybrid_users": f"""SELECT user_id, {PROFILE}, {_compliments()} FROM ratings JOIN part ON item_id = p_partkey
        WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1""",
    "items": """SELECT item_id,
        ((4 * sum(stars)::BIGINT + count(*)) // (2 * count(*))) / 2.0::DOUBLE AS business_avg_stars, count(*) AS business_rev_count FROM ratings
        WHERE item_id IN (SELECT p_partkey FROM part WHERE p_size > 1) GROUP BY 1""",
    "tips": """SELECT user_id, item_id, count(*) AS tips, count(*) FILTER (WHERE stars >= 4) AS likes FROM train
        GROUP BY 1, 2""",
    "stats": """SELECT user_id, avg(pow(stars - average_stars, 2)) AS user_variance, max(stars) AS user_max,
        min(stars) AS user_min, count(*) AS rating_rows, var_samp(stars) AS sample
        FROM train JOIN users USING (user_id) WHERE item_id IN (SELECT item_id FROM items) GROUP BY 1""",
    # baskets of documents
    "words": r"""SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS t
        FROM documents""",
    "shingles": """SELECT DISTINCT doc_id AS item,
        unnest([array_to_string(t[k:k+2], ' ') FOR k IN range(1, greatest(len(t) - 1, 2))]) AS member FROM words
        WHERE len(t) > 0""",
    "codes": "SELECT member, row_number() OVER (ORDER BY member) - 1 AS code FROM (SELECT DISTINCT member FROM shingles)",
    "signature": """SELECT item, h, min((h * code + 1) % (SELECT count(*) FROM codes)) AS m
        FROM shingles JOIN codes USING (member), range(90) AS r(h) GROUP BY 1, 2""",
    "bands": """SELECT item, h // 2 AS band, max(CASE WHEN h % 2 = 0 THEN m END) AS k0,
        max(CASE WHEN h % 2 = 1 THEN m END) AS k1 FROM signature GROUP BY 1, 2""",
    "candidates": """SELECT DISTINCT x.item AS a, y.item AS b FROM bands x JOIN bands y
        ON x.band = y.band AND x.k0 = y.k0 AND x.k1 = y.k1 AND x.item < y.item""",
    "sizes": "SELECT item, count(*) AS n FROM shingles GROUP BY 1",
    "shared": """SELECT x.item AS a, y.item AS b, count(*) AS common FROM shingles x JOIN shingles y
        ON x.member = y.member AND x.item < y.item GROUP BY 1, 2""",
    "exact": """SELECT a, b, common / (p.n + q.n - common) AS similarity FROM shared
        JOIN sizes p ON p.item = a JOIN sizes q ON q.item = b WHERE 2 * common >= p.n + q.n - common""",
    "lsh": "SELECT exact.* FROM exact JOIN candidates USING (a, b)",
    # equal sets under their least item
    "families": """SELECT min(item) OVER (PARTITION BY held) AS rep, item
        FROM (SELECT item, string_agg(member, '|' ORDER BY member) AS held FROM shingles GROUP BY 1)""",
    # item-based prediction
    "rated": """SELECT user_id AS u, item_id AS i, arg_max(stars, (ok, ln, sk, stars)) AS r, sum(stars) AS s,
        count(*) AS n FROM train GROUP BY 1, 2""",
    "it": """SELECT i, sum(s)::HUGEINT AS s, sum(n)::HUGEINT AS n, sum(r)::HUGEINT AS s1, sum(r * r)::HUGEINT AS s2,
        count(*)::HUGEINT AS raters FROM rated GROUP BY 1""",
    "us": "SELECT u, sum(s) AS s, sum(n) AS n, count(*) AS profile FROM rated GROUP BY 1",
    "targets": """SELECT user_id AS u, item_id AS i, rated.r AS known, us.s / us.n AS user_avg,
        it.s::DOUBLE / it.n::DOUBLE AS item_avg, us.profile,
        CASE WHEN rated.r IS NOT NULL THEN 'already_rated'
             WHEN us.u IS NOT NULL AND it.i IS NOT NULL THEN 'both_known'
             WHEN it.i IS NOT NULL THEN 'cold_user' WHEN us.u IS NOT NULL THEN 'cold_item' ELSE 'both_cold' END AS cell
        FROM test LEFT JOIN rated ON rated.u = user_id AND rated.i = item_id
        LEFT JOIN us ON us.u = user_id LEFT JOIN it ON it.i = item_id""",
    "neighbours": """SELECT t.u, t.i, r.i AS j, r.r, least(t.i, r.i) AS a, greatest(t.i, r.i) AS b
        FROM targets t JOIN rated r ON r.u = t.u WHERE t.cell = 'both_known'""",
    "needed": """SELECT DISTINCT least(item_id, i) AS a, greatest(item_id, i) AS b
        FROM test JOIN rated ON u = user_id AND i <> item_id WHERE item_id IN (SELECT i FROM rated)""",
    "sums": """SELECT x.i AS a, y.i AS b, count(*)::HUGEINT AS c, sum(x.r)::HUGEINT AS sa, sum(y.r)::HUGEINT AS sb,
        sum(x.r * x.r)::HUGEINT AS saa, sum(y.r * y.r)::HUGEINT AS sbb, sum(x.r * y.r)::HUGEINT AS sab
        FROM rated x JOIN rated y ON x.u = y.u AND x.i < y.i GROUP BY 1, 2""",
}

PEARSON = {
    "common": """SELECT needed.a, needed.b, coalesce(c, 0) AS n_common, p.s / p.n AS avg_a, q.s / q.n AS avg_b,
        (p.n * q.n * sab - p.s * q.n * sb - q.s * p.n * sa + c * p.s * q.s)::DOUBLE AS num,
        (p.n * p.n * saa - 2 * p.n * p.s * sa + c * p.s * p.s)::DOUBLE AS da,
        (q.n * q.n * sbb - 2 * q.n * q.s * sb + c * q.s * q.s)::DOUBLE AS db""",
    # from the definition: over the union of the users, a missing rating being the item's average over the common users;
    # the deviation of each user, times the item's rating count and the number of common users, is a whole number
    "default_voting": """SELECT needed.a, needed.b, coalesce(c, 0) AS n_common, p.s / p.n AS avg_a, q.s / q.n AS avg_b,
        num::DOUBLE AS num, da::DOUBLE AS da, db::DOUBLE AS db""",
}
UNION = {
    "common_voters": """SELECT s.a, s.b, c, sa, sb, x.r::HUGEINT AS ra, y.r::HUGEINT AS rb FROM needed JOIN sums s USING (a, b)
        JOIN rated x ON x.i = s.a JOIN rated y ON y.i = s.b AND y.u = x.u""",
    "single_voters": """SELECT s.a, s.b, c, sa, sb, x.r::HUGEINT AS ra, NULL::HUGEINT AS rb FROM needed JOIN sums s USING (a, b)
        JOIN rated x ON x.i = s.a ANTI JOIN rated y ON y.i = s.b AND y.u = x.u
        UNION ALL SELECT s.a, s.b, c, sa, sb, NULL, y.r FROM needed JOIN sums s USING (a, b)
        JOIN rated y ON y.i = s.b ANTI JOIN rated x ON x.i = s.a AND x.u = y.u""",
    "deviations": """SELECT a, b, p.n * coalesce(c * ra, sa) - c * p.s AS va, q.n * coalesce(c * rb, sb) - c * q.s AS vb
        FROM (SELECT * FROM common_voters UNION ALL SELECT * FROM single_voters) JOIN it p ON p.i = a JOIN it q ON q.i = b""",
    "voted": "SELECT a, b, sum(va * vb) AS num, sum(va * va) AS da, sum(vb * vb) AS db FROM deviations GROUP BY 1, 2",
}


# computed once, so that no slow plan is picked
STORED = dict.fromkeys(("uc", "ic", "labels"), "MATERIALIZED ")


def _with(ctes: dict[str, str], query: str) -> str:
    return "WITH " + ",\n".join(f"{name} AS {STORED.get(name, '')}({body})" for name, body in ctes.items()) + "\n" + query


def _sql(query: str, *names: str, extra: dict[str, str] | None = None) -> str:
    return _with({n: CTES[n] for n in CTES if n in names} | (extra or {}), query)


RATINGS = ("ratings", "marked")
PLAIN_FEATURES = USER_FEATURES + ITEM_FEATURES
BASKETS = ("words", "shingles")
SIGNED = (*BASKETS, "codes", "signature")
EXACT = (*BASKETS, "sizes", "shared", "exact")
LSH = (*SIGNED, "bands", "candidates", *EXACT, "lsh")
PROFILES = (*RATINGS, "train", "test", "users", "items")
RATED = (*RATINGS, "train", "test", "rated", "it", "us")
CF = (*RATED, "targets", "neighbours", "needed", "sums")


def _similarities(mode: str = "common", min_common: int | None = None) -> dict[str, str]:
    halve = f"CASE WHEN n_common < {min_common} THEN 0.5::DOUBLE ELSE 1 END" if min_common else "1"
    voted = mode == "default_voting"
    return (UNION if voted else {}) | {
        "terms": f"""{PEARSON[mode]} FROM needed LEFT JOIN sums ON sums.a = needed.a AND sums.b = needed.b
            {"LEFT JOIN voted ON voted.a = needed.a AND voted.b = needed.b" if voted else ""} JOIN it p ON p.i = needed.a JOIN it q ON q.i = needed.b""",
        "pair_sims": f"""SELECT a, b, n_common, CASE
            WHEN n_common = 0 THEN least(avg_a, avg_b) / greatest(avg_a, avg_b)
            WHEN num = 0 THEN 0 ELSE num / (sqrt(da) * sqrt(db)) * {halve} END AS sim FROM terms"""}


def _cf(rho: float, k: int | None = None, mode: str = "common", min_common: int | None = None,
        cold: str = "averages") -> dict[str, str]:
    best = f"QUALIFY row_number() OVER (PARTITION BY u, i ORDER BY sim DESC, j) <= {k}" if k else ""
    on_cold = {"cold_user": "item_avg", "cold_item": "user_avg"} if cold == "averages" else {
        "cold_user": "2.5", "cold_item": "2.5"}
    return _similarities(mode, min_common) | {
        "weights": f"""SELECT u, i, r, pow(sim, {rho}) AS w FROM neighbours JOIN pair_sims USING (a, b)
            WHERE sim > 0 {best}""",
        "weighted": "SELECT u, i, sum(r * w) / sum(w) AS p FROM weights GROUP BY 1, 2",
        "cf": f"""SELECT u AS user_id, i AS item_id, profile, CASE cell WHEN 'already_rated' THEN known
            WHEN 'both_known' THEN least(5, coalesce(p, (user_avg + item_avg) / 2))
            WHEN 'cold_user' THEN {on_cold['cold_user']} WHEN 'cold_item' THEN {on_cold['cold_item']}
            ELSE 2.5 END::DOUBLE AS prediction FROM targets LEFT JOIN weighted USING (u, i)"""}


def _predictions(value: str = "round(prediction, 6)", **options) -> str:
    return _sql(f"SELECT user_id, item_id, {value} AS prediction FROM cf", *CF, extra=_cf(**options))


def _filled(features: tuple[str, ...]) -> str:
    return ", ".join(f"coalesce({f}, {MISSING})::DOUBLE AS {f}" if f != "user_variance"
                     else f"round(coalesce({f}, {MISSING}), 6)::DOUBLE AS {f}" for f in features)


WEIGHT = """SELECT user_id, item_id, coalesce(profile, 0) AS neighbours,
    coalesce(profile, 0) / (SELECT max(profile) FROM test JOIN us ON us.u = user_id) AS alpha
    FROM test LEFT JOIN us ON us.u = user_id"""
LABELS = """SELECT concat('u', user_id) AS ul, concat('i', item_id) AS il, stars, 'train' AS part FROM train UNION ALL
    SELECT concat('u', user_id), concat('i', item_id), stars, 'test' FROM test"""

def _stump(rows: str, test: str) -> dict[str, str]:
    """The split ``x <= v`` of ``rows (x, y)`` with the least squared error, and the mean of the side of each test row."""
    return {
        "fitted": rows,
        "splits": """SELECT v, sum(y) FILTER (WHERE x <= v) / count(*) FILTER (WHERE x <= v) AS low,
            sum(y) FILTER (WHERE x > v) / count(*) FILTER (WHERE x > v) AS high,
            pow(sum(y) FILTER (WHERE x <= v), 2) / count(*) FILTER (WHERE x <= v)
            + pow(sum(y) FILTER (WHERE x > v), 2) / count(*) FILTER (WHERE x > v) AS gain
            FROM (SELECT DISTINCT x AS v FROM fitted), fitted GROUP BY 1 HAVING count(*) FILTER (WHERE x > v) > 0""",
        "stump": "SELECT * FROM splits ORDER BY gain DESC LIMIT 1",
        "scored": f"SELECT user_id, item_id, CASE WHEN x <= v THEN low ELSE high END AS score FROM ({test}), stump"}


def _boosted(rows: str, test: str, features: tuple[str, ...], rounds: int, step: float) -> dict[str, str]:
    """Rounds of stumps: each is the best split of any feature for twice the residual that is left, ``step`` times after the first."""
    tables = {"r0": f"SELECT {', '.join(features)}, y::DOUBLE AS y, 0::DOUBLE AS f FROM ({rows})",
              "t0": f"SELECT *, 0::DOUBLE AS f FROM ({test})"}
    for k in range(rounds):
        goal = "y" if k == 0 else "2 * (y - f)"
        tables[f"values{k}"] = " UNION ALL ".join(
            f"SELECT '{x}' AS feature, {x} AS x, sum({goal}) AS s, count(*) AS n FROM r{k} GROUP BY 2" for x in features)
        # sums and counts of the values up to each one, and of the others
        tables[f"cuts{k}"] = f"""SELECT feature, x AS v, sum(s) OVER below AS sl, sum(n) OVER below AS nl,
            sum(s) OVER whole - sum(s) OVER below AS sr, sum(n) OVER whole - sum(n) OVER below AS nr FROM values{k}
            WINDOW below AS (PARTITION BY feature ORDER BY x), whole AS (PARTITION BY feature)"""
        tables[f"best{k}"] = f"""SELECT feature, v, sl / nl AS low, sr / nr AS high FROM cuts{k} WHERE nr > 0
            ORDER BY sl * sl / nl + sr * sr / nr DESC LIMIT 1"""
        side = "CASE feature " + " ".join(f"WHEN '{x}' THEN {x}" for x in features) + " END"
        weight = 1.0 if k == 0 else step
        for name in ("r", "t"):
            tables[f"{name}{k + 1}"] = f"""SELECT {name}{k}.* REPLACE (f + {weight}::DOUBLE * CASE WHEN {side} <= v THEN low ELSE high END AS f)
                FROM {name}{k}, best{k}"""
    return tables


def _universal() -> str:
    """Signatures with the hash family that the seed draws."""
    draw = random.Random(UNIVERSAL)
    rows = ", ".join(f"({h}, {draw.randrange(1, MERSENNE_31)}, {draw.randrange(MERSENNE_31)})" for h in range(UNIVERSAL))
    return f"""SELECT item, h::BIGINT AS h, min((x::BIGINT * (code % {MERSENNE_31}) + y::BIGINT) % {MERSENNE_31}) AS m
        FROM shingles JOIN codes USING (member), (VALUES {rows}) AS f(h, x, y) GROUP BY 1, 2"""


CF_TEXT = """SELECT user_id::VARCHAR AS user_id, item_id::VARCHAR AS business_id, round(prediction, 6) AS prediction FROM cf"""
_OF_SETS = """SELECT a, b, round(similarity, 6) AS similarity FROM {} WHERE a IN (SELECT rep FROM families)
    AND b IN (SELECT rep FROM families)"""

ORACLES = {
    "ratings_latest": _sql("""SELECT user_id, item_id, arg_max(stars, (ok, ln, sk, stars)) AS stars FROM ratings
        GROUP BY 1, 2""", "ratings"),
    "item_stats": _sql("""SELECT item_id, sum(stars)::BIGINT AS rating_sum, count(*) AS rating_count,
        round(avg(stars), 6) AS rating_avg, count(DISTINCT user_id) AS raters FROM train GROUP BY 1""",
                       *RATINGS, "train"),
    "user_stats": _sql("""SELECT user_id, sum(stars)::BIGINT AS rating_sum, count(*) AS rating_count,
        round(avg(stars), 6) AS rating_avg, count(DISTINCT item_id) AS profile FROM train GROUP BY 1""",
                       *RATINGS, "train"),
    "split_train_test": _sql(f"""SELECT user_id, item_id, stars, ok, ln, sk, CASE WHEN f < 0.6 THEN 'train'
        WHEN f < 0.8 THEN 'validation' ELSE 'test' END AS split
        FROM (SELECT *, {_fraction('1', 'user_id', 'item_id')} AS f FROM ratings)""", "ratings"),
    "prepared_ratings": _sql("""SELECT user_id, item_id, stars FROM ratings
        WHERE item_id IN (SELECT p_partkey FROM part WHERE p_type = 'ECONOMY')""", "ratings"),
    "cold_start_cells": _sql("SELECT u AS user_id, i AS item_id, cell FROM targets", *RATED, "targets"),
    "user_codes": _sql("""SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS code
        FROM (SELECT DISTINCT user_id FROM train)""", *RATINGS, "train"),
    "minhash_signatures": _sql("SELECT item, h, m FROM signature", *SIGNED),
    "lsh_universal": _sql(_universal(), *BASKETS, "codes"),
    "lsh_bands": _sql("SELECT item, band, k0, k1 FROM bands", *SIGNED, "bands"),
    "lsh_candidates": _sql("""SELECT a, b FROM candidates WHERE a IN (SELECT rep FROM families)
        AND b IN (SELECT rep FROM families)""", *SIGNED, "bands", "candidates", "families"),
    "similar_sets_exact": _sql(_OF_SETS.format("exact"), *EXACT, "families"),
    "similar_sets_lsh": _sql(_OF_SETS.format("lsh"), *LSH, "families"),
    "similar_items_lookup": _sql("""SELECT item, other, round(similarity, 6) AS similarity FROM
        (SELECT a AS item, b AS other, similarity FROM exact UNION ALL SELECT b, a, similarity FROM exact)
        WHERE item IN (SELECT doc_id FROM labels)""", *EXACT),
    "set_families": _sql("SELECT rep, item FROM families", *BASKETS, "families"),
    "similar_items_lsh": _sql("SELECT a, b, round(similarity, 6) AS similarity FROM lsh", *LSH),
    "similar_items_exact": _sql("SELECT a, b, round(similarity, 6) AS similarity FROM exact", *EXACT),
    "similar_items_by_raters": _sql("""SELECT a, b, round(common / (p.n + q.n - common), 6) AS similarity
        FROM (SELECT x.i AS a, y.i AS b, count(*) AS common FROM rated x JOIN rated y ON x.u = y.u AND x.i < y.i
              GROUP BY 1, 2)
        JOIN (SELECT i, count(*) AS n FROM rated GROUP BY 1) p ON p.i = a
        JOIN (SELECT i, count(*) AS n FROM rated GROUP BY 1) q ON q.i = b
        WHERE common / (p.n + q.n - common) >= 0.08::DOUBLE""", *RATINGS, "train", "rated"),
    "lsh_precision_recall": _sql("""SELECT found, truth, hits, round(hits / found, 6) AS precision,
        round(hits / truth, 6) AS recall FROM (SELECT (SELECT count(*) FROM lsh) AS found,
        (SELECT count(*) FROM exact) AS truth, (SELECT count(*) FROM lsh JOIN exact USING (a, b)) AS hits)""", *LSH),
    "item_pair_similarity": _sql("SELECT a, b, round(sim, 6) AS similarity, n_common::BIGINT AS n_common FROM pair_sims",
                                 *CF, extra=_similarities()),
    "item_cf_rho25": _predictions(rho=2.5),
    "item_cf_rho6": _predictions(rho=6.0),
    "item_cf_topk": _predictions(rho=2.5, k=10),
    "item_cf_default_voting": _predictions(rho=2.5, mode="default_voting"),
    "item_cf_min_common": _predictions(rho=2.5, min_common=5),
    "item_cf_rescaled": _predictions("""round((prediction - (SELECT min(prediction) FROM cf))
        / ((SELECT max(prediction) FROM cf) - (SELECT min(prediction) FROM cf)) * 4 + 1, 6)""", rho=2.5),
    "item_cf_whole_stars": _predictions("round(prediction, 0)", rho=2.5),
    "item_cf_cold_default": _predictions(rho=2.5, cold="default"),
    "item_cf_half_stars": _predictions("round(prediction / 2, 6)", rho=2.5),
    "item_cf_repeated_rows": _sql("""SELECT user_id, item_id, round(prediction, 6) AS prediction
        FROM marked JOIN cf USING (user_id, item_id) WHERE held_out""", *CF, extra=_cf(rho=2.5)),
    "co_rated_similarity": _sql("SELECT a, b, round(sim, 6) AS similarity, n_common::BIGINT AS n_common FROM pair_sims",
                                *RATINGS, "train", "rated", "it", "sums",
                                extra={"needed": "SELECT a, b FROM sums"} | _similarities()),
    "user_rating_stats": _sql("""SELECT user_id, round(user_variance, 6) AS user_variance, user_max, user_min,
        rating_rows FROM stats""", *PROFILES, "stats"),
    "user_sample_variance": _sql("""SELECT user_id, round(sample, 6) AS user_variance, user_max, user_min,
        rating_rows FROM stats""", *PROFILES, "stats"),
    "label_encode": _sql("""SELECT coalesce(x.c, (SELECT count(*) FROM uc)) AS user_label,
        coalesce(y.c, (SELECT count(*) FROM ic)) AS item_label, stars, part
        FROM labels LEFT JOIN uc x USING (ul) LEFT JOIN ic y USING (il)""", *RATINGS, "train", "test", extra={
            "labels": LABELS,
            "uc": """SELECT DISTINCT ul, dense_rank() OVER (ORDER BY ul) - 1 AS c FROM labels WHERE part = 'train'""",
            "ic": """SELECT DISTINCT il, dense_rank() OVER (ORDER BY il) - 1 AS c FROM labels WHERE part = 'train'"""}),
    "train_features": _sql(f"""SELECT user_id, item_id, train.stars, {_filled(MODEL_FEATURES)} FROM train
        JOIN users USING (user_id) JOIN items USING (item_id) LEFT JOIN stats USING (user_id)""", *PROFILES, "stats"),
    "test_features": _sql(f"""SELECT user_id, item_id, {_filled(MODEL_FEATURES)} FROM test
        LEFT JOIN users USING (user_id) LEFT JOIN items USING (item_id) LEFT JOIN stats USING (user_id)""",
                          *PROFILES, "stats"),
    "hybrid_features": _sql(f"""SELECT user_id, item_id, {_filled(HYBRID_FEATURES)} FROM test
        LEFT JOIN hybrid_users USING (user_id) LEFT JOIN items USING (item_id)""",
                            *RATINGS, "test", "hybrid_users", "items"),
    "hybrid_train_features": _sql(f"""SELECT user_id, item_id, train.stars, {_filled(HYBRID_FEATURES)} FROM train
        JOIN hybrid_users USING (user_id) JOIN items USING (item_id)""", *RATINGS, "train", "hybrid_users", "items"),
    "feature_vectors": _sql(f"""SELECT user_id, item_id, unnest(range({len(MODEL_FEATURES)})) AS place,
        unnest([{", ".join(MODEL_FEATURES)}]) AS value FROM (SELECT user_id, item_id, {_filled(MODEL_FEATURES)} FROM test
        LEFT JOIN users USING (user_id) LEFT JOIN items USING (item_id) LEFT JOIN stats USING (user_id))""",
                            *PROFILES, "stats"),
    "features_with_extra": _sql(f"""SELECT user_id, item_id, {_filled(PLAIN_FEATURES + ("tips", "likes"))} FROM test
        LEFT JOIN users USING (user_id) LEFT JOIN items USING (item_id) LEFT JOIN tips USING (user_id, item_id)""",
                                *PROFILES, "tips"),
    "features_numeric_text": _sql(f"""SELECT user_id, item_id, {_filled(PLAIN_FEATURES)},
        CASE WHEN user_id % 7 = 0 OR review_count IS NULL THEN {MISSING} ELSE user_id END::DOUBLE AS postal_code FROM test
        LEFT JOIN users USING (user_id) LEFT JOIN items USING (item_id)""", *PROFILES),
    "model_stump": _sql("SELECT user_id, item_id, round(score, 6) AS prediction FROM scored", *PROFILES, "stats",
                        extra=_stump("""SELECT user_min AS x, train.stars AS y FROM train JOIN users USING (user_id)
                            JOIN items USING (item_id) JOIN stats USING (user_id)""",
                                     f"""SELECT user_id, item_id, coalesce(user_min, {MISSING}) AS x FROM test
                            LEFT JOIN stats USING (user_id)""")),
    "hybrid_stump": _sql("""SELECT user_id, item_id, round(alpha * prediction + (1 - alpha) * score, 6) AS prediction
        FROM cf JOIN weight USING (user_id, item_id) JOIN scored USING (user_id, item_id)""", *CF, "hybrid_users", "items",
                         extra=_cf(rho=6.0) | {"weight": WEIGHT} | _stump(
                             """SELECT business_avg_stars AS x, train.stars AS y FROM train JOIN hybrid_users USING (user_id)
                                 JOIN items USING (item_id)""",
                             f"""SELECT user_id, item_id, coalesce(business_avg_stars, {MISSING}) AS x FROM test
                                 LEFT JOIN items USING (item_id)""")),
    "model_boosted_stumps": _sql(f"SELECT user_id, item_id, round(f, 6) AS prediction FROM t{STUMPS['trees']}", *PROFILES, "stats",
                                 extra=_boosted("""SELECT user_min, business_avg_stars, train.stars AS y FROM train
                                     JOIN users USING (user_id) JOIN items USING (item_id) JOIN stats USING (user_id)""",
                                                f"""SELECT user_id, item_id, coalesce(user_min, {MISSING}) AS user_min,
                                     coalesce(business_avg_stars, {MISSING}) AS business_avg_stars FROM test
                                     LEFT JOIN stats USING (user_id) LEFT JOIN items USING (item_id)""",
                                                BOOSTED, STUMPS["trees"], STUMPS["step"])),
    "ratings_quarantine": _sql(f"""SELECT CASE WHEN whole THEN user_id::VARCHAR END AS user_id,
        CASE WHEN whole THEN item_id::VARCHAR END AS business_id, CASE WHEN whole THEN stars::DOUBLE END AS stars,
        CASE kind WHEN 1 THEN concat(user_id, ',', item_id) WHEN 2 THEN concat(user_id, ',', item_id, ',star', stars)
            WHEN 3 THEN concat(user_id, ',', item_id, ',', stars, ',x') END AS line,
        CASE kind WHEN 1 THEN '3 fields expected, 2 found' WHEN 2 THEN 'stars is no double'
            WHEN 3 THEN '3 fields expected, 4 found' END AS reason
        FROM (SELECT *, ok % {BROKEN} AS kind, ok % {BROKEN} NOT IN (1, 2, 3) AS whole FROM train)""", *RATINGS, "train"),
    "item_profiles_json": _sql("SELECT item_id::VARCHAR AS business_id, business_avg_stars AS stars, business_rev_count AS review_count FROM items", "ratings", "items"),
    "ratings_csv": _sql("""SELECT user_id::VARCHAR AS user_id, item_id::VARCHAR AS business_id, stars::DOUBLE AS stars
        FROM train""", *RATINGS, "train"),
    "profiles_json": _sql("""SELECT user_id::VARCHAR AS user_id, average_stars, review_count, useful, fans, funny, cool
        FROM hybrid_users""", "ratings", "hybrid_users"),
    "pairs_sink": _sql("""SELECT a::VARCHAR AS business_id_1, b::VARCHAR AS business_id_2, similarity
        FROM (""" + _OF_SETS.format("exact") + ")", *EXACT, "families"),
    "predictions_sink": _sql(CF_TEXT, *CF, extra=_cf(rho=2.5)),
    "hybrid_weight": _sql("SELECT user_id, item_id, neighbours, round(alpha, 6) AS alpha FROM weight", *RATED,
                          extra={"weight": WEIGHT}),
    "hybrid_weight_lifted": _sql("""SELECT user_id, item_id, neighbours,
        round(CASE WHEN alpha <= 0.3::DOUBLE THEN alpha + 0.2::DOUBLE ELSE alpha END, 6) AS alpha FROM weight""",
                                 *RATED, extra={"weight": WEIGHT}),
    "hybrid_cf_useravg": _sql("""SELECT user_id, item_id, round(alpha * prediction
        + (1 - alpha) * coalesce(us.s / us.n, 2.5), 6) AS prediction
        FROM cf JOIN weight USING (user_id, item_id) LEFT JOIN us ON us.u = user_id""", *CF,
                              extra=_cf(rho=6.0) | {"weight": WEIGHT}),
    "rmse_item_cf": _sql("""SELECT count(*) AS rows, round(sqrt(avg(pow(prediction - stars, 2))), 6) AS rmse
        FROM cf JOIN test USING (user_id, item_id)""", *CF, extra=_cf(rho=2.5)),
    "prediction_range": _sql("""SELECT round(min(prediction), 6) AS lowest, round(max(prediction), 6) AS highest
        FROM cf""", *CF, extra=_cf(rho=2.5)),
}
