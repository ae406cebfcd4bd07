"""SQL of those queries of this subpackage that SQL can express, over the same tables."""

from __future__ import annotations

from affinis.llm.mixing import BLOCK, BUCKET_DOCS, SEED, SHARD_DOCS


def _number(text: str, start: int) -> str:
    return f"CAST(concat('0x', substr({text}, {start}, 8)) AS BIGINT)"


def _picked(j: str) -> str:
    return f"""(CASE WHEN {j} <= blocks1 THEN CASE WHEN blocks1 > 0 THEN (({j}) * pick1 + start1) // blocks1 ELSE 0 END
        ELSE pick1 + (({j} - blocks1) * pick2 + start2) // (blocks - blocks1) END)"""


def _words_to(position: str) -> str:
    j = f"least(({position}) // {BLOCK}, blocks)"
    inside = f"CASE WHEN {j} < blocks THEN ({position} - {j} * {BLOCK}) * ({_picked(f'{j} + 1')} - {_picked(j)}) ELSE 0 END"
    return f"({_picked(j)} * {BLOCK} + {inside})"


def _start(k: int) -> str:
    return _number(f"md5(concat_ws(':', '{SEED}/{k}', coalesce(source, 'null'), shard::VARCHAR))", 1)


#: seats straight from the definition: every quotient is a row, the highest are taken
MIX = rf"""WITH sized AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
        md5(concat_ws(':', '{SEED}', coalesce(doc_id::VARCHAR, 'null'), md5(coalesce(text, '')))) AS mark FROM documents),
    line AS (SELECT *, CASE WHEN size > 0 THEN {_number('mark', 1)} % greatest(1, (count(*) FILTER (WHERE size > 0) OVER
        (PARTITION BY source) + {SHARD_DOCS - 1}) // {SHARD_DOCS}) ELSE -1 END AS shard,
        ({_number('mark', 9)} * {SHARD_DOCS // BUCKET_DOCS}) // 4294967296 AS bucket FROM sized),
    cells AS (SELECT source, shard, sum(size)::BIGINT AS cell, (2 * sum(size)::BIGINT) // {BLOCK} AS most FROM line GROUP BY 1, 2),
    sums AS (SELECT source, sum(cell)::BIGINT AS source_size, sum(most)::BIGINT AS most FROM cells GROUP BY 1),
    ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM sums),
    weighed AS (SELECT *, [3, 1, 2][rank % 3 + 1] AS weight FROM ranked),
    stopped AS (SELECT *, (1.5 * sum(source_size) OVER () - 2 * coalesce(sum(source_size) OVER earlier, 0))::DOUBLE * weight
        >= (2 * source_size * (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)))::DOUBLE AS stops FROM weighed
        WINDOW earlier AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    aimed AS (SELECT *, CASE WHEN stops THEN (2 * source_size)::DOUBLE
        ELSE ((1.5 * sum(source_size) OVER () - 2 * sum(CASE WHEN stops THEN source_size ELSE 0 END) OVER ())::DOUBLE
            / (sum(CASE WHEN stops THEN 0 ELSE weight END) OVER ())::DOUBLE) * weight END AS target FROM stopped),
    quotients AS (SELECT source, rank, target / (2 * unnest(range(most)) + 1) AS quotient FROM aimed WHERE target > 0),
    seated AS (SELECT source, count(*) AS seats FROM (SELECT source FROM quotients
        QUALIFY row_number() OVER (ORDER BY quotient DESC, rank) <= (SELECT floor(sum(target) / {BLOCK} + 0.5) FROM aimed)) GROUP BY 1),
    cell_quotients AS (SELECT source, shard, cell::DOUBLE / (2 * unnest(range(most)) + 1) AS quotient FROM cells WHERE cell > 0),
    cell_seats AS (SELECT q.source, shard, count(*) AS quota FROM (SELECT source, shard,
        row_number() OVER (PARTITION BY source ORDER BY quotient DESC, shard) AS place FROM cell_quotients) q
        JOIN seated s ON s.source IS NOT DISTINCT FROM q.source WHERE place <= seats GROUP BY 1, 2),
    quotas AS (SELECT c.source, c.shard, cell, most AS blocks, cell // {BLOCK} AS blocks1, coalesce(quota, 0) AS quota FROM cells c
        LEFT JOIN cell_seats s ON s.source IS NOT DISTINCT FROM c.source AND s.shard = c.shard),
    picks AS (SELECT *, least(quota, blocks1) AS pick1, quota - least(quota, blocks1) AS pick2,
        CASE WHEN blocks1 > 0 THEN {_start(1)} % blocks1 ELSE 0 END AS start1,
        CASE WHEN blocks > blocks1 THEN {_start(2)} % (blocks - blocks1) ELSE 0 END AS start2 FROM quotas),
    placed AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source, shard ORDER BY bucket, mark, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS pos FROM line)
    SELECT doc_id, size::BIGINT AS size, source_size, target, ({_words_to('pos + size')} - {_words_to('pos')}
        + {_words_to('cell + pos + size')} - {_words_to('cell + pos')})::BIGINT AS taken
    FROM placed JOIN picks p ON p.source IS NOT DISTINCT FROM placed.source AND p.shard = placed.shard
    JOIN aimed a ON a.source IS NOT DISTINCT FROM placed.source"""



def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    bit = "lambda x, _: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], {bit})"
    codes = f"list_transform(range(1, len({text}) + 1), lambda i: ascii(substr({text}, i, 1))::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), {byte}), 4294967295)"


def _tree(name: str, leaves: str, levels: int) -> str:
    """Tables of the levels of the trees in ``leaves (tree, place, digest)``: nodes, and what stands before and after each in its run."""
    tables = [f"{name}0 AS (SELECT tree, place, digest FROM {leaves})"]
    for k in range(levels):
        tables.append(f"""{name}{k}_counted AS (SELECT *, count(*) OVER (PARTITION BY tree) = 1 AS lone FROM {name}{k}),
    {name}{k}_run AS (SELECT a.tree, a.place, any_value(a.lone) AS lone,
        coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place < a.place), '') AS before,
        coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (WHERE b.place > a.place), '') AS after
        FROM {name}{k}_counted a JOIN {name}{k}_counted b ON a.tree IS NOT DISTINCT FROM b.tree AND a.place // 16 = b.place // 16
        GROUP BY a.tree, a.place),
    {name}{k + 1} AS (SELECT tree, place // 16 AS place, CASE WHEN any_value(lone) THEN any_value(digest)
        ELSE sha256(string_agg(digest, '' ORDER BY place)) END AS digest FROM {name}{k}_counted GROUP BY tree, place // 16)""")
    return ",\n    ".join(tables)


def _fold(name: str, rows: str, levels: int, out: str) -> str:
    """``rows (tree, place, value, proof, other columns)`` with value and proof led up to the trees' tops."""
    tables, before = [], rows
    for k in range(levels):
        after = out if k == levels - 1 else f"{out}_{k}"
        tables.append(f"""{after} AS (SELECT l.* REPLACE (
        CASE WHEN r.lone THEN l.value ELSE sha256(r.before || l.value || r.after) END AS value,
        l.proof || r.before || r.after AS proof) FROM {before} l JOIN {name}{k}_run r
        ON l.tree IS NOT DISTINCT FROM r.tree AND l.place // {16 ** k} = r.place)""")
        before = after
    return ",\n    ".join(tables)


def _written(column: str) -> str:
    return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"


_LEVELS = 7
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_REST = " || ".join(_written(c) for c in ("doc_id", "source", "lang", "n_chars"))
#: level by level; 16 ** 7 rows of a source
MANIFEST = f"""WITH hashed AS (SELECT doc_id, source AS tree, sha256({_REST} || {_written('text')}) AS digest,
        CASE WHEN {_crc32('doc_id::VARCHAR')} % 5 = 0 THEN sha256({_REST} || {_written(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")})
        ELSE sha256({_REST} || {_written('text')}) END AS value FROM documents),
    leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS place FROM hashed),
    {_tree('node', 'leaves', _LEVELS)},
    {_fold('node', "(SELECT *, '' AS proof FROM leaves)", _LEVELS, 'folded')},
    subroots AS (SELECT '' AS tree, tree AS source, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS place FROM node{_LEVELS}),
    {_tree('top', 'subroots', _LEVELS)},
    placed AS (SELECT f.doc_id, f.digest AS leaf, s.digest AS subroot, s.tree, s.place, f.value, f.proof
        FROM folded f JOIN subroots s ON f.tree IS NOT DISTINCT FROM s.source),
    {_fold('top', 'placed', _LEVELS, 'done')}
    SELECT doc_id, leaf, subroot, t.digest AS root, sha256(proof) AS proof_sha256, value AS folded_root, value = t.digest AS verified
    FROM done CROSS JOIN top{_LEVELS} t"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: five hexadecimal digits are four characters
_CHARACTER = (f"substr('{_BASE32}', ((CAST(concat('0x', substr(h, (i // 4) * 5 + 1, 5)) AS BIGINT) >> (15 - 5 * (i % 4))) & 31)::BIGINT + 1, 1)")
ARCHIVED = f"""WITH keyed AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS key,
        sha1(coalesce(html, '')) AS h FROM pages),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY page_id DESC NULLS LAST) AS number,
        max(page_id) OVER (PARTITION BY key) AS best FROM keyed)
    SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: {_CHARACTER}), '') AS payload_digest,
        CASE WHEN number = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN number > 1 THEN best END AS refers_to
    FROM ranked"""

ORACLES = {"op3_mixing_sources": MIX, "op11_merkle_manifest": MANIFEST, "op12_warc": ARCHIVED}
