"""SQL for DuckDB that the queries are held against, where SQL can express them."""

from __future__ import annotations

from .decontaminate import COST, MASKS, MIN_EQUAL, SCORE, SHORT, SHORTEST, masks_for

_MASK_ROWS = ", ".join(f"({k}, {list(mask)}, {lengths or [0]})" for k, (mask, lengths) in enumerate(masks_for(range(SHORTEST, SHORT + 1))))

#: Every diagonal that a seed hits is walked whole; running sums and their least value so far
#: give the best stretch that ends at each word, the first sum as low as the one at a word the
#: widest stretch there that does not fall. The second counts where the first has too few equal words.
LEAKS = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, w FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+') AS w FROM benchmark WHERE text IS NOT NULL)
      WHERE len(w) >= {SHORTEST}),
m AS (SELECT * FROM (VALUES {_MASK_ROWS}) t(k, o, lengths) WHERE lengths = [0] OR EXISTS (SELECT 1 FROM b WHERE list_contains(lengths, len(w)))),
dp AS (SELECT doc_id, w, unnest(range(len(w))) AS p FROM d),
bp AS (SELECT item_id, w, unnest(range(len(w))) AS p FROM b),
ds AS (SELECT doc_id, k, p, list_transform(o, lambda x: w[p + x + 1]) AS seed FROM dp, m WHERE p + o[-1] < len(w)),
bs AS (SELECT item_id, k, p, list_transform(o, lambda x: w[p + x + 1]) AS seed FROM bp, m
       WHERE p + o[-1] < len(w) AND CASE WHEN lengths = [0] THEN len(w) > {MASKS[0][-1]} ELSE list_contains(lengths, len(w)) END),
diagonals AS (SELECT DISTINCT doc_id, item_id, ds.p - bs.p AS g FROM ds JOIN bs USING (k, seed)),
spread AS (SELECT doc_id, item_id, g, d.w AS dw, b.w AS bw, unnest(range(len(b.w))) AS i
           FROM diagonals JOIN d USING (doc_id) JOIN b USING (item_id)),
sums AS (SELECT doc_id, item_id, g, i, len(bw) AS n,
                sum(CASE WHEN dw[g + i + 1] = bw[i + 1] THEN {SCORE} ELSE -{COST} END)
                    OVER (PARTITION BY doc_id, item_id, g ORDER BY i) AS s,
                row_number() OVER (PARTITION BY doc_id, item_id, g ORDER BY i) AS nth
         FROM spread WHERE g + i BETWEEN 0 AND len(dw) - 1),
lows AS (SELECT *, coalesce(least(0 - (i - nth + 1), min(s * 100000 - (i + 1)) OVER (PARTITION BY doc_id, item_id, g ORDER BY i
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 0 - (i - nth + 1)) AS v FROM sums),
ends AS (SELECT *, s - CAST(ceil(v / 100000.0) AS BIGINT) AS gain, CAST(ceil(v / 100000.0) AS BIGINT) * 100000 - v AS start FROM lows),
best AS (SELECT doc_id, item_id, g, n, start, i + 1 - start AS size, (gain + {COST} * (i + 1 - start)) // {SCORE + COST} AS equal
         FROM ends QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, g ORDER BY gain DESC, i) = 1),
whole AS (SELECT doc_id, item_id, g, n, min(i) AS first, list_prepend(0, list(s ORDER BY i)) AS t FROM sums GROUP BY ALL),
places AS (SELECT *, unnest(range(1, len(t))) AS e FROM whole),
since AS (SELECT *, list_position(list_transform(t[1:e], lambda x: x <= t[e + 1]), true) AS j FROM places),
wide AS (SELECT doc_id, item_id, g, n, first + j - 1 AS start, e + 1 - j AS size, (t[e + 1] - t[j] + {COST} * (e + 1 - j)) // {SCORE + COST} AS equal
         FROM since WHERE j > 0 QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, g ORDER BY equal DESC, e) = 1),
found AS (SELECT * FROM best WHERE equal >= least({MIN_EQUAL}, ceil(n * 0.8)) UNION ALL
          SELECT wide.* FROM wide JOIN best USING (doc_id, item_id, g)
          WHERE best.equal < least({MIN_EQUAL}, ceil(best.n * 0.8)) AND wide.equal >= least({MIN_EQUAL}, ceil(wide.n * 0.8)))
SELECT doc_id, item_id, CAST(equal AS INTEGER) AS equal_words, CAST(size AS INTEGER) AS overlap_words,
       CAST(g + start AS INTEGER) AS doc_word, CAST(start AS INTEGER) AS item_word
FROM found
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY equal DESC, size DESC, g + start, start) = 1"""
