"""SQL of the operators that SQL can express, for comparison on the same tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

#: CRC-32, a byte at a time: the remainder of every byte, then a fold over the bytes of the text.
_CRC_STEPS = """
    steps AS (
        SELECT b, list_reduce(list_prepend(b::BIGINT, range(8)),
                              lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS r
        FROM range(256) t(b)
    ),
    folded AS (SELECT list(r ORDER BY b) AS rest FROM steps)"""

_CRC = f"""{_CRC_STEPS},
    raw AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    bytes AS (
        SELECT doc_id, length(h) // 2 AS n,
               list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::BIGINT) AS b
        FROM raw
    ),
    sized AS (
        SELECT doc_id, n + 8 AS size,
               xor(list_reduce(list_prepend(4294967295::BIGINT, b),
                               lambda c, x: xor(c >> 8, rest[xor(c & 255, x) + 1])), 4294967295) AS text_crc32
        FROM bytes, folded
    )"""

SHARDS = f"""
    WITH {_CRC},
    summed AS (
        SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto,
               sum(size) OVER ()::BIGINT AS total
        FROM sized
    ),
    placed AS (
        SELECT *, least((2 * upto - size)::HUGEINT * 24 // (2 * total), 23)::INT AS shard FROM summed
    )
    SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
           row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32, size) - 1 AS slot,
           NULL::INT AS grown_shard
    FROM placed"""

MIX = rf"""
    WITH words AS (
        SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents
    ),
    counted AS (
        SELECT doc_id, source, len(w) AS size,
               len(list_filter(w, lambda x: regexp_full_match(x, '\p{{L}}+[.,;:?]?'))) AS clean
        FROM words
    ),
    keyed AS (
        SELECT *, -ln((('0x' || substr(md5('mix:' || doc_id), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0)
                  / greatest(clean::DOUBLE / greatest(size, 1)::DOUBLE, 0.05) AS k
        FROM counted
    ),
    summed AS (
        SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto
        FROM keyed
    ),
    totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY source),
    weighted AS (
        SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight,
               source_size * 2.0::DOUBLE AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS whole
        FROM totals
    ),
    ranked AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS r FROM weighted),
    levelled AS (
        SELECT *, (whole - coalesce(sum(cap) OVER (ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
                  / sum(weight) OVER (ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM ranked
    ),
    goals AS (
        SELECT source, source_size,
               CASE WHEN cap / weight <= level THEN cap
                    ELSE weight * (SELECT level FROM levelled WHERE cap / weight > level ORDER BY r LIMIT 1) END AS target
        FROM levelled
    ),
    budgets AS (
        SELECT *, floor(target / greatest(source_size, 1)) AS epochs,
               target - floor(target / greatest(source_size, 1)) * source_size AS budget
        FROM goals
    )
    SELECT s.doc_id, s.size, b.source_size, b.target,
           ((epochs + CASE WHEN budget > 0 AND upto - s.size / 2.0 <= budget THEN 1 ELSE 0 END) * s.size)::BIGINT AS taken
    FROM summed s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source"""

JOIN = rf"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
        FROM documents
    ),
    shingles AS (
        SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM words WHERE len(w) > 0)
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    shared AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
    ),
    links AS (
        SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
        WHERE 100 * c >= 85 * (x.n + y.n - c)
    ),
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id
    FROM documents d LEFT JOIN sizes USING (doc_id)
    LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) f ON f.a = d.doc_id"""


def _field(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR END"


def _levels(name: str, start: str) -> str:
    """All nodes of binary trees over ``start`` (``tree, pos, h, n``), by level; ``n`` counts the nodes of a level."""
    return f"""{name} AS (
        SELECT tree, 0 AS level, pos, h, n FROM {start}
        UNION ALL
        SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
        FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 2, n
    )"""


def _path(nodes: str, place: str, first: int) -> str:
    """The steps from a place (``doc_id, tree, pos``): L or R and the sibling, or - without one."""
    return f"""
        SELECT p.doc_id, {first} + l.level AS step,
               CASE WHEN s.h IS NULL THEN '-' WHEN (p.pos >> l.level) & 1 = 1 THEN 'L' || s.h ELSE 'R' || s.h END AS hop
        FROM {place} p JOIN (SELECT DISTINCT tree, level, n FROM {nodes} WHERE n > 1) l ON l.tree = p.tree
        LEFT JOIN {nodes} s ON s.tree = p.tree AND s.level = l.level AND s.pos = xor(p.pos >> l.level, 1)"""


_LEAF = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))
_CLAIM = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "(n_chars + 1)", "text"))

MERKLE = f"""
    WITH RECURSIVE {_CRC_STEPS},
    ids AS (SELECT *, hex(encode(doc_id::VARCHAR)) AS x FROM documents),
    summed AS (
        SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT,
                          list_transform(range(length(x) // 2), lambda i: ('0x' || substr(x, (2 * i + 1)::BIGINT, 2))::BIGINT)),
                          lambda c, b: xor(c >> 8, rest[xor(c & 255, b) + 1])), 4294967295) AS crc
        FROM ids, folded
    ),
    leaves AS (
        SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({_LEAF}) AS h,
               sha256(CASE WHEN crc % 7 = 0 THEN {_CLAIM} ELSE {_LEAF} END) AS claimed
        FROM summed
    ),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
        FROM leaves
    ),
    {_levels("nodes", "placed")},
    subroots AS (SELECT tree AS lang, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
    numbered AS (SELECT '' AS tree, pos, h, n FROM subroots),
    {_levels("tops", "numbered")},
    upper AS (SELECT doc_id, '' AS tree, s.pos FROM placed p JOIN subroots s ON s.lang = p.tree),
    hops AS ({_path("nodes", "placed", 0)} UNION ALL {_path("tops", "upper", 1000)}),
    paths AS (
        SELECT doc_id, list(hop ORDER BY step) AS hops, string_agg(substr(hop, 2), '' ORDER BY step) AS joined
        FROM hops GROUP BY doc_id
    ),
    folds AS (
        SELECT p.doc_id, p.h AS leaf, s.h AS subroot, (SELECT h FROM tops WHERE n = 1) AS root,
               sha256(coalesce(joined, '')) AS proof_sha256,
               list_reduce(list_prepend(claimed, coalesce(hops, [])), lambda c, hop:
                   CASE hop[1] WHEN '-' THEN sha256(c) WHEN 'L' THEN sha256(hop[2:] || c) ELSE sha256(c || hop[2:]) END
               ) AS folded_root
        FROM placed p JOIN subroots s ON s.lang = p.tree LEFT JOIN paths USING (doc_id)
    )
    SELECT *, folded_root = root AS verified FROM folds"""

COLLOCATIONS = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    runs AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
        FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, (VALUES (1), (2), (3)) t(k))
    ),
    counts AS (SELECT lang, k, phrase, count(*) AS f FROM runs GROUP BY ALL),
    sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10),
    cuts AS (
        SELECT *, array_to_string(w[1:cut], ' ') AS head, array_to_string(w[cut + 1:], ' ') AS tail
        FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates)
    ),
    scored AS (
        SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, cut, (1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f))::BIGINT AS score
        FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail
    ),
    lowest AS (
        SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    ),
    covered AS (
        SELECT lang, phrase, max(a) AS inside
        FROM (SELECT lang, a, array_to_string(w[i:i + 1], ' ') AS phrase FROM candidates, (VALUES (1), (2)) t(i) WHERE k = 3)
        GROUP BY ALL
    ),
    ranked AS (
        SELECT o.*, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, o.phrase) AS rank
        FROM lowest o LEFT JOIN covered v ON v.lang = o.lang AND v.phrase = o.phrase
        WHERE inside IS NULL OR 100 * inside < 50 * a
    )
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""

SQL = {
    "op5_ngram_join": JOIN,
    "op8_byte_shards": SHARDS,
    "op9_source_mix": MIX,
    "op11_merkle": MERKLE,
    "op13_collocations": COLLOCATIONS,
}
