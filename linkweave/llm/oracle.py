"""SQL for the operators whose statements are put together from parts."""

from __future__ import annotations

#: Levels that the statement spells out: trees of up to 8^8 leaves, and 8^3 trees.
TREE_LEVELS, ROOT_LEVELS = 8, 3


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text; 3988292384 is the checksum's polynomial."""
    return f"""xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda d: ascii(d)::BIGINT)),
        lambda c, b: list_reduce(
            list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
            lambda x, z: xor(x >> 1, (x & 1) * 3988292384)
        )
    ), 4294967295)"""


def _leaf(text: str) -> str:
    def field(value: str) -> str:
        return f"coalesce(strlen({value}::VARCHAR)::VARCHAR || ':' || {value}::VARCHAR, '-')"

    return "sha256(" + " || ".join(map(field, ["doc_id", "source", "lang", "n_chars", text])) + ")"


def _levels(prefix: str, levels: int) -> str:
    """Each level of the trees as a table of its own; a single node is carried on unchanged."""
    return ",\n".join(
        f"""{prefix}{k + 1} AS (
            SELECT tree, p AS i, CASE WHEN max(n) = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY i)) END AS digest,
                ceil(max(n) / 8)::BIGINT AS n
            FROM (SELECT *, i // 8 AS p FROM {prefix}{k}) GROUP BY tree, p
        )"""
        for k in range(levels)
    )


def _folds(prefix: str, first: str, name: str, levels: int) -> str:
    """Siblings and the digest folded so far, level by level."""
    steps = []
    for k in range(levels):
        before = first if k == 0 else f"{name}{k}"
        steps.append(f"""{name}{k + 1} AS (
            SELECT f.uid, any_value(f.tree) AS tree, any_value(f.i) // 8 AS i,
                any_value(f.proof) || coalesce(string_agg(m.digest, '' ORDER BY m.i) FILTER (WHERE m.i <> f.i), '') AS proof,
                CASE WHEN max(m.n) = 1 THEN any_value(f.folded)
                    ELSE sha256(string_agg(CASE WHEN m.i = f.i THEN f.folded ELSE m.digest END, '' ORDER BY m.i)) END AS folded
            FROM {before} f JOIN (SELECT *, i // 8 AS p FROM {prefix}{k}) m ON m.tree = f.tree AND m.p = f.i // 8
            GROUP BY f.uid
        )""")
    return ",\n".join(steps)


def merkle() -> str:
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        WITH rows AS (
            SELECT row_number() OVER () AS uid, doc_id, coalesce('=' || lang, '-') AS tree, {_leaf('text')} AS leaf,
                CASE WHEN {_crc32('doc_id::VARCHAR')} % 3 = 0 THEN {_leaf(lowered)} ELSE {_leaf('text')} END AS now
            FROM documents
        ),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, uid) - 1 AS i,
                count(*) OVER (PARTITION BY tree) AS n
            FROM rows
        ),
        t0 AS (SELECT tree, i, leaf AS digest, n FROM placed),
        {_levels('t', TREE_LEVELS)},
        tops AS (
            SELECT tree AS name, row_number() OVER (ORDER BY tree) - 1 AS i, digest, count(*) OVER () AS n FROM t{TREE_LEVELS}
        ),
        r0 AS (SELECT '' AS tree, i, digest, n FROM tops),
        {_levels('r', ROOT_LEVELS)},
        f0 AS (SELECT uid, tree, i, '' AS proof, now AS folded FROM placed),
        {_folds('t', 'f0', 'f', TREE_LEVELS)},
        g0 AS (SELECT f.uid, '' AS tree, t.i, f.proof, f.folded FROM f{TREE_LEVELS} f JOIN tops t ON t.name = f.tree),
        {_folds('r', 'g0', 'g', ROOT_LEVELS)}
        SELECT p.doc_id, p.leaf, t.digest AS subroot, r.digest AS root, sha256(g.proof) AS proof_sha256,
            g.folded AS folded_root, g.folded = r.digest AS verified
        FROM placed p JOIN g{ROOT_LEVELS} g ON g.uid = p.uid JOIN tops t ON t.name = p.tree CROSS JOIN r{ROOT_LEVELS} r
    """


def lexical() -> str:
    """Every document scored for every item by plain joins."""
    terms = (
        r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    )
    return f"""
        WITH rows AS (SELECT row_number() OVER () AS uid, doc_id, text FROM documents),
        words AS (SELECT uid, doc_id, unnest({terms}) AS term FROM rows),
        tfs AS (SELECT uid, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        lengths AS (SELECT uid, sum(tf)::BIGINT AS n FROM tfs GROUP BY uid),
        total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM lengths),
        weights AS (
            SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM tfs, total GROUP BY term
        ),
        items AS (SELECT row_number() OVER () AS number, item_id, text FROM benchmark),
        asked AS (SELECT DISTINCT number, item_id, unnest({terms}) AS term FROM items),
        scored AS (
            SELECT number, item_id, uid, doc_id,
                sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN lengths USING (uid), total
            GROUP BY number, item_id, uid, doc_id
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY number ORDER BY score DESC, doc_id NULLS FIRST, uid) AS rank
            FROM scored WHERE score > 0
        )
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
    """
