"""Reference SQL of those operator queries that SQL can express, for DuckDB.

Written from the definitions: all pairs, all windows, all token combinations.
Missing are the text of pages, the classifier, repeated strings, fingerprints,
packing and token counts; those are tested against brute force.
"""

from __future__ import annotations

from ackline.llm.contamination import SHINGLE
from ackline.llm.licenses import CONTAINMENT, TEMPLATES
from ackline.llm.urls import LISTED

_CUT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _words(text: str) -> str:
    return (
        f"list_filter(regexp_split_to_array(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_CUT}'),"
        " lambda w: w <> '')"
    )


def _shingles(parts: str, size: int = 5) -> str:
    return f"list_transform(range(1, len({parts}) - {size} + 2), lambda i: array_to_string({parts}[i:i + {size - 1}], ' '))"


def _runs(parts: str, size: str) -> str:
    """All runs of ``size`` (a column) words."""
    return f"list_transform(range(1, len({parts}) - {size} + 2), lambda i: array_to_string({parts}[i:i + {size} - 1], ' '))"


NEAR_DUPLICATES = rf"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\x20\x09-\x0D]+'),
                             lambda w: w <> '') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM cut),
rows_ AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS an, b.n AS bn, count(*) AS common
  FROM rows_ a JOIN rows_ b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
   AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
links AS (SELECT a, b FROM pairs WHERE 100 * common >= 80 * (an + bn - common)),
both_ AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS r FROM documents UNION SELECT reach.a, both_.b FROM reach JOIN both_ ON reach.r = both_.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r) AS component_id, s.doc_id = min(r) AS kept
FROM sets s JOIN reach ON reach.a = s.doc_id GROUP BY s.doc_id, s.s"""

_SIMILARITY = """
weighed AS (
  SELECT p.key, p.item_id, s, len(list_filter(p.ws, lambda x: x = s)) AS wc, len(list_filter(p.its, lambda x: x = s)) AS ic
  FROM (SELECT *, unnest(list_distinct(list_concat(ws, its))) AS s FROM near) p),
judged AS (
  SELECT key, item_id, CAST(sum(least(wc, ic) * length(s)) AS DOUBLE) / sum(greatest(wc, ic) * length(s)) AS similarity
  FROM weighed GROUP BY ALL)"""

CONTAMINATION = f"""
WITH item AS (
  SELECT item_id, w, len(w) AS n, least({SHINGLE}, len(w)) AS k, {_runs('w', f'least({SHINGLE}, len(w))')} AS s
  FROM (SELECT item_id, {_words('text')} AS w FROM benchmark) WHERE len(w) > 0),
item_rows AS (SELECT DISTINCT n, k, unnest(s) AS shingle, unnest(range(len(s))) AS at_ FROM item),
doc AS (SELECT doc_id, {_words('text')} AS w FROM documents),
doc_rows AS (SELECT doc_id, k, unnest({_runs('w', 'k')}) AS shingle, unnest(range(len(w) - k + 1)) AS place
             FROM doc, (SELECT DISTINCT k FROM item) WHERE len(w) >= k),
places AS (SELECT DISTINCT doc_id, greatest(place - at_, 0) AS start, n FROM doc_rows JOIN item_rows USING (k, shingle)),
windows AS (SELECT doc_id, start, n, array_to_string(w[start + 1:start + n], ' ') AS key FROM places JOIN doc USING (doc_id)),
cut AS (SELECT DISTINCT n, key, string_split(key, ' ') AS kw FROM windows),
near AS (SELECT cut.key, item_id, {_runs('kw', f'least({SHINGLE}, len(kw))')} AS ws, s AS its FROM cut JOIN item ON cut.n = item.n),
{_SIMILARITY.strip()},
found AS (SELECT doc_id, item.item_id, similarity, start
          FROM windows JOIN judged USING (key) JOIN item ON item.item_id = judged.item_id AND item.n = windows.n
          WHERE similarity >= 0.8)
SELECT doc_id, item_id, max(similarity) AS similarity,
       CAST(arg_min(start, (-similarity, start)) AS INTEGER) AS first_word
FROM found GROUP BY doc_id, item_id"""

_TEMPLATES = ", ".join(f"({i}, {_quoted(name)}, {_quoted(text)})" for i, (name, text) in enumerate(TEMPLATES))

LICENSES = f"""
WITH template AS (
  SELECT t, license, k, list_distinct({_runs('w', 'k')}) AS s
  FROM (SELECT t, license, w, least(5, len(w)) AS k
        FROM (SELECT t, license, {_words('body')} AS w FROM (VALUES {_TEMPLATES}) v(t, license, body)))),
sized AS (SELECT *, len(s) AS n, greatest(1, len(s) // 4) AS step FROM template WHERE len(s) > 0),
doc AS (SELECT doc_id, k, {_runs('w', 'k')} AS h
        FROM (SELECT doc_id, {_words('text')} AS w FROM documents), (SELECT DISTINCT k FROM sized) WHERE len(w) >= k),
hit AS (SELECT DISTINCT doc_id, h, t FROM doc JOIN sized ON doc.k = sized.k AND list_has_any(h, s)),
tried AS (
  SELECT doc_id, license, hit.t, n, s, h, unnest(range(0, len(h), step)) AS start FROM hit JOIN sized USING (t)),
held AS (
  SELECT doc_id, license, t, start, n, len(list_intersect(s, h[start + 1:start + n])) AS inner_,
         len(list_intersect(s, h[greatest(start - n // 2, 0) + 1:greatest(start - n // 2, 0) + 2 * n])) AS outer_
  FROM tried)
SELECT doc_id, license, CAST(arg_min(t, (-outer_ / n, start, t)) AS INTEGER) AS template,
       CAST(max(outer_ / n) AS DOUBLE) AS containment, CAST(arg_min(start, (-outer_ / n, start, t)) AS INTEGER) AS first_word
FROM held WHERE inner_ > 0 AND outer_ / n >= {CONTAINMENT} GROUP BY doc_id, license"""


def _case(column: int) -> str:
    ranked = sorted(LISTED, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    arms = [
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, v)[column]}'"
        for h, p, v in ranked
    ]
    return "CASE " + " ".join(arms) + " END"


URLS = rf"""
WITH RECURSIVE page AS (
  SELECT page_id, url, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
part AS (
  SELECT *, translate(path, '{_UPPER}', '{_LOWER}') AS low, regexp_extract(coalesce(url, ''), '(?s)^[^?#]*\?([^#]*)', 1) AS query FROM page),
token AS (
  SELECT page_id, url, list_distinct(list_concat(
    list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x),
    list_transform(list_filter(string_split(low, '/'), lambda x: x <> ''), lambda x: 'p:' || regexp_replace(x, '[0-9]+', '0', 'g')),
    list_transform(list_filter([regexp_extract(low, '\.([a-z0-9]{{1,8}})$', 1)], lambda x: x <> ''), lambda x: 'x:' || x),
    list_transform(list_filter(list_transform(string_split(query, '&'), lambda x: string_split(x, '=')[1]), lambda x: x <> ''), lambda x: 'q:' || x))) AS has
  FROM part),
labelled AS (SELECT row_number() OVER () AS r, has, quality = 0 AS blocked FROM token JOIN labels ON page_id = doc_id WHERE quality IS NOT NULL),
wanted AS (SELECT ceil(greatest(0.002 * count(*), 5) - 1e-9) AS least,
                  least(1, 2 * CAST(count(*) FILTER (blocked) AS DOUBLE) / count(*)) AS sure FROM labelled),
each AS (SELECT r, blocked, unnest(has) AS a FROM labelled),
one AS (SELECT * FROM each SEMI JOIN (
  SELECT a FROM each GROUP BY a HAVING count(*) FILTER (blocked) >= (SELECT least FROM wanted)) often USING (a)),
combo AS (
  SELECT r, blocked, a, [a] AS items FROM one
  UNION ALL SELECT c.r, c.blocked, o.a, list_append(c.items, o.a) FROM combo c JOIN one o ON c.r = o.r AND o.a > c.a),
rule AS (SELECT items FROM combo GROUP BY items
         HAVING count(*) FILTER (blocked) >= (SELECT least FROM wanted)
            AND count(*) FILTER (blocked) / count(*) >= (SELECT sure FROM wanted)),
mined AS (SELECT DISTINCT url FROM token JOIN rule ON list_has_all(has, items))
SELECT page_id, host, path, {_case(0)} AS rule,
  coalesce({_case(1)}, CASE WHEN url IN (SELECT url FROM mined WHERE url IS NOT NULL) THEN 'block' END, 'allow') AS verdict
FROM page"""

FILL_IN_MIDDLE = """
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS parts,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
drawn AS (
  SELECT *, CAST(len(parts) - (CASE WHEN parts[-1] = '' THEN 1 ELSE 0 END) AS BIGINT) AS n,
         list_transform(range(4), lambda k: CAST('0x' || substr(digest, CAST(8 * k + 1 AS BIGINT), 8) AS BIGINT)) AS h FROM doc),
cut AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
sized AS (
  SELECT *, CASE WHEN low = 0 THEN 0 ELSE least(length(text), length(array_to_string(parts[:low], chr(10))) + 1) END AS p,
         CASE WHEN high = 0 THEN 0 ELSE least(length(text), length(array_to_string(parts[:high], chr(10))) + 1) END AS q FROM cut),
made AS (
  SELECT *, CASE form WHEN 'plain' THEN text
      WHEN 'psm' THEN '<P>' || substr(text, 1, p) || '<S>' || substr(text, q + 1) || '<M>' || substr(text, p + 1, q - p)
      ELSE '<S>' || substr(text, q + 1) || '<P>' || substr(text, 1, p) || '<M>' || substr(text, p + 1, q - p) END AS output FROM sized)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(p AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(q - p AS BIGINT) END AS middle_chars,
       sha256(output) AS output_sha256, sha256(text) AS restored_sha256
FROM made"""

# CRC-32 of a word's UTF-8 bytes, from the polynomial: a table of 256 remainders, then byte by byte.
RESAMPLING = r"""
WITH tab AS (
  SELECT list(c ORDER BY b) AS t FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END) AS c
    FROM (SELECT unnest(range(256)) AS b))),
said AS (
  SELECT doc_id, 'd' AS kind, {doc_words} AS w FROM documents
  UNION ALL SELECT item_id, 't', {doc_words} FROM benchmark),
word AS (SELECT DISTINCT unnest(w) AS word FROM said),
bytes AS (
  SELECT word, list_transform(range(0, strlen(word)), lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT)) AS b FROM word),
hashed AS (
  SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, b),
           lambda c, x: xor(t[CAST(xor(c, x) % 256 + 1 AS BIGINT)], c // 256))) % 10000 AS bucket FROM bytes, tab),
used AS (SELECT kind, doc_id, bucket FROM (SELECT kind, doc_id, unnest(w) AS word FROM said) JOIN hashed USING (word)),
counted AS (
  SELECT b.bucket, count(u.bucket) FILTER (kind = 'd') AS s, count(u.bucket) FILTER (kind = 't') AS t
  FROM (SELECT unnest(range(10000)) AS bucket) b LEFT JOIN used u ON u.bucket = b.bucket GROUP BY b.bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (sum(s) OVER () + 10000.0::DOUBLE)
                                     / ((s + 1.0::DOUBLE) * (sum(t) OVER () + 10000.0::DOUBLE)))) AS BIGINT) AS g FROM counted),
weighed AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(x.weight, 0) AS weight
  FROM said d LEFT JOIN (SELECT doc_id, sum(g) AS weight FROM used JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY doc_id) x
    ON x.doc_id = d.doc_id WHERE d.kind = 'd'),
scored AS (
  SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, CAST(weight + floor(-1000 * ln(-ln(
    (CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score FROM weighed),
placed AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)""".replace("{doc_words}", _words("text"))

NEAR_VECTORS = """
WITH RECURSIVE given AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
vec AS (
  SELECT r, vec_id, list_transform(v, lambda x: x / sqrt(list_sum(list_transform(v, lambda y: y * y)))) AS u FROM given
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.r AS a, b.r AS b FROM vec a JOIN vec b ON a.r <> b.r AND len(a.u) = len(b.u) AND list_inner_product(a.u, b.u) >= 0.95),
reach AS (SELECT r AS a, r AS x FROM given UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.x = links.a),
least AS (SELECT reach.a, min(vec_id) AS component_id FROM reach JOIN given ON reach.x = given.r GROUP BY reach.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = g.r) AS n_links, component_id,
       component_id IS NOT DISTINCT FROM vec_id AS kept
FROM given g JOIN least ON least.a = g.r"""

ORACLES: dict[str, str] = {
    "op6_near_duplicates": NEAR_DUPLICATES,
    "op7_judge_urls": URLS,
    "op9_scan_licenses": LICENSES,
    "op10_find_contamination": CONTAMINATION,
    "op11_resample": RESAMPLING,
    "op12_near_duplicate_vectors": NEAR_VECTORS,
    "op13_fill_in_middle": FILL_IN_MIDDLE,
}
