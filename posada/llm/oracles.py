"""SQL counterparts, where SQL can express the operator."""

# CRC-32 of a list of bytes, bit by bit: a byte is taken in where x is not negative, and each -1 is one division step.
_CRC = """xor(list_reduce(flatten(list_transform({bytes}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, 4294967295::BIGINT), 4294967295)"""


def crc32_of_digits(number: str) -> str:
    """CRC-32 of a number in decimal."""
    return _CRC.format(bytes=f"list_transform(string_split({number}::VARCHAR, ''), lambda d: ord(d)::BIGINT)")


def _framed(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({column}::VARCHAR) || ':' || {column}::VARCHAR END"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_framed(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


_UP = "list_transform(range(0, len(nodes), 16), lambda i: sha256(array_to_string(nodes[i + 1:i + 16], '')))"
_SIBLINGS = "[array_to_string(nodes[(pos // 16) * 16 + 1:pos], ''), array_to_string(nodes[pos + 2:(pos // 16) * 16 + 16], '')]"

ORACLES: dict[str, str] = {
    "op1_warc_archives": """
        WITH held AS (
          SELECT page_id, coalesce(html, '') AS payload,
            max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last
          FROM pages)
        SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest,
          CASE WHEN strlen(payload) >= 1000 AND last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
          CASE WHEN strlen(payload) >= 1000 AND last IS NOT NULL AND page_id IS DISTINCT FROM last THEN last END AS refers_to
        FROM held""",
    "op11_merkle_manifest": f"""
        WITH RECURSIVE rows AS (
          SELECT *, {_leaf('text')} AS leaf,
            CASE WHEN {crc32_of_digits('doc_id')} % 5 = 0
              THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS claimed
          FROM documents),
        placed AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM rows),
        trees AS (
          SELECT source, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY source
          UNION ALL SELECT source, level + 1, {_UP} FROM trees WHERE len(nodes) > 1),
        subroots AS (
          SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place FROM trees WHERE len(nodes) = 1),
        forest AS (
          SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
          UNION ALL SELECT level + 1, {_UP} FROM forest WHERE len(nodes) > 1),
        path AS (
          SELECT p.doc_id, p.leaf, p.place AS row, t.source, 1 AS part, t.level, p.place // (16 ** t.level)::BIGINT AS pos, t.nodes
          FROM placed p JOIN trees t ON p.source IS NOT DISTINCT FROM t.source WHERE len(t.nodes) > 1
          UNION ALL
          SELECT p.doc_id, p.leaf, p.place, p.source, 2, f.level, s.place // (16 ** f.level)::BIGINT, f.nodes
          FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source CROSS JOIN forest f WHERE len(f.nodes) > 1),
        proofs AS (
          SELECT source, row, list({_SIBLINGS} ORDER BY part, level) AS proof FROM path GROUP BY source, row),
        starts AS (
          SELECT p.source, p.place AS row, coalesce(q.proof, []) AS proof, coalesce(p.claimed, p.leaf) AS start
          FROM placed p LEFT JOIN proofs q ON p.source IS NOT DISTINCT FROM q.source AND p.place = q.row),
        folded AS (
          SELECT source, row, proof, 0 AS done, start AS value FROM starts
          UNION ALL
          SELECT source, row, proof, done + 1, sha256(proof[done + 1][1] || value || proof[done + 1][2]) FROM folded WHERE done < len(proof))
        SELECT p.doc_id, p.leaf, s.subroot, r.root, sha256(array_to_string(flatten(f.proof), '')) AS proof_sha256,
          f.value AS folded_root, f.value = r.root AS verified
        FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source
        JOIN folded f ON p.source IS NOT DISTINCT FROM f.source AND p.place = f.row AND f.done = len(f.proof)
        CROSS JOIN (SELECT nodes[1] AS root FROM forest WHERE len(nodes) = 1) r""",
    "op12_target_resampling": f"""
        WITH texts AS (
          SELECT 'd' AS part, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
        worded AS (
          SELECT part, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
        starts AS (SELECT part, id, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
        runs AS (SELECT part, id, w, i, unnest([1, 2, 3]) AS n FROM starts),
        features AS (
          SELECT part, id, array_to_string(w[i:i + n - 1], ' ') AS feature, count(*) AS times
          FROM runs WHERE i + n - 1 <= len(w) GROUP BY 1, 2, 3),
        distinct_features AS (SELECT DISTINCT feature, hex(encode(feature)) AS h FROM features),
        hashed AS (
          SELECT feature, {_CRC.format(bytes="list_transform(range(1, len(h), 2), lambda p: ('0x' || h[p:p + 1])::BIGINT)")} % 10000 AS bucket
          FROM distinct_features),
        placed AS (SELECT part, id, bucket, sum(times)::BIGINT AS times FROM features JOIN hashed USING (feature) GROUP BY 1, 2, 3),
        buckets AS (
          SELECT bucket, coalesce(sum(times) FILTER (part = 'd'), 0)::DOUBLE AS s, coalesce(sum(times) FILTER (part = 'b'), 0)::DOUBLE AS t
          FROM placed GROUP BY bucket),
        totals AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM buckets),
        gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (all_s + 10000) / ((s + 1) * (all_t + 10000))))::BIGINT AS gain FROM buckets, totals),
        weights AS (
          SELECT id AS doc_id, sum(times)::BIGINT AS n_features, sum(times * gain)::BIGINT AS weight
          FROM placed JOIN gains USING (bucket) WHERE part = 'd' GROUP BY id),
        noised AS (
          SELECT id AS doc_id, len(w) AS n_words, ('0x' || substr(sha256('42:' || id), 1, 8))::BIGINT AS h FROM worded WHERE part = 'd'),
        scored AS (
          SELECT doc_id, n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
            coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
          FROM noised LEFT JOIN weights USING (doc_id)),
        ranked AS (
          SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () * 5 // 100 AS wanted
          FROM scored WHERE n_words >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= wanted THEN place END AS rank
        FROM scored LEFT JOIN ranked USING (doc_id)""",
    "op13_exact_dedup": r"""
        WITH normal AS (
          SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\v\f\r]', '', 'g') AS body, length(coalesce(text, '')) AS chars
          FROM documents),
        placed AS (
          SELECT *, first_value(doc_id) OVER best AS keep_id, row_number() OVER best AS place, count(*) OVER (PARTITION BY body) AS group_size
          FROM normal WINDOW best AS (PARTITION BY body ORDER BY chars DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM placed""",
}
