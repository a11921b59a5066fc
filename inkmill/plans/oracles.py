"""DuckDB SQL for the queries of ``queries.py``."""

from __future__ import annotations

from inkmill.functions import han, rules
from inkmill.operators import audit
from inkmill.plans import fixtures as fx
from inkmill.plans.queries import PREFIXES
from inkmill.plans.schemas import MANIFEST


def _s(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _list(xs: list[str]) -> str:
    return "[" + ", ".join(map(_s, xs)) + "]"


def _rule(name: str, table: dict[str, list[str]], default: str) -> str:
    hits = (" OR ".join(f"contains(lower({name}), {_s(w)})" for w in ws) + f" THEN {_s(k)}" for k, ws in table.items())
    return "(CASE " + " ".join(f"WHEN {h}" for h in hits) + f" ELSE {_s(default)} END)"


def _strip(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(13))"


def _raw(rel: str) -> str:
    return f"('_raw/all/' || CASE WHEN contains({rel}, '/') THEN replace({rel}, '/', '__') || '.' || sha256({rel})[1:10] ELSE {rel} END || '.txt')"


def _md(rel: str, name: str) -> str:
    nested = f"replace({rel}, '/', '__') || '.' || sha256({rel})[1:10] || '.md'"
    return f"(CASE WHEN {rel} IS NULL THEN regexp_replace({name}, '\\.[^.]*$', '') || '.md' WHEN contains({rel}, '/') THEN {nested} ELSE {rel} || '.md' END)"


_CATEGORY = _rule("name", rules.CATEGORIES, rules.OTHER)
_SUB = _rule("name", rules.SUBCATEGORIES, rules.GENERAL)
_HAN_TEXT = f"translate(lower(text), '{fx.LATIN}', '{fx.HAN_LETTERS}')"
_EXTRACTABLE = "('.pdf', '.pptx', '.docx', '.doc', '.epub')"
_UNIT = "CASE ext WHEN '.pdf' THEN 'pages' WHEN '.pptx' THEN 'slides' WHEN '.docx' THEN 'paragraphs' WHEN '.doc' THEN 'doc' WHEN '.epub' THEN 'chapters' END"
_JUDGE = """(CASE ext WHEN '.pdf' THEN CASE WHEN chars / units >= 80 THEN 'text' WHEN chars / units >= 15 THEN 'sparse' ELSE 'image' END
 WHEN '.pptx' THEN CASE WHEN chars / units >= 60 THEN 'text' WHEN chars / units >= 12 THEN 'sparse' ELSE 'image' END
 WHEN '.docx' THEN CASE WHEN chars >= 200 THEN 'text' ELSE 'sparse' END WHEN '.doc' THEN CASE WHEN chars >= 200 THEN 'text' ELSE 'sparse' END
 WHEN '.epub' THEN 'text' END)"""

_FILES = f"""d AS (SELECT doc_id, text, (doc_id % 8)::INT AS e, doc_id // 8 AS g FROM documents),
r AS (SELECT *, CASE WHEN g % 5 = 0 THEN '' ELSE 'd' || (g % 5) || '/' END || list_extract({_list(fx.STEMS)}, (g % 12)::INT + 1) || '_'
 || CASE WHEN e = 6 AND g % 3 <> 0 THEN doc_id - 2 ELSE doc_id END || list_extract({_list(fx.EXTENSIONS)}, e + 1) AS rel FROM d),
f0 AS (SELECT *, regexp_extract(rel, '[^/]*$') AS name, list_extract({_list(fx.EXTENSIONS)}, e + 1) AS ext,
 ((length(text) - length(replace(text, chr(10), '')) + 1) * (1 + g % 40))::INT AS units, strlen(text) AS size, sha256(text) AS source_sha256,
 length({_strip("text")})::INT AS chars FROM r),
books AS (SELECT regexp_replace(rel, '\\.[^.]*$', '') AS stem, max(rel) AS book FROM f0 WHERE ext = '.epub' GROUP BY 1),
files AS (SELECT f0.*, CASE WHEN ext = '.mobi' THEN book END AS dup FROM f0 LEFT JOIN books ON stem = regexp_replace(rel, '\\.[^.]*$', ''))"""


def _fields(values: dict[str, str]) -> str:
    return ", ".join(f"{values.get(x.name, 'NULL')}::{ {'LongType': 'BIGINT', 'IntegerType': 'INT', 'StringType': 'VARCHAR', 'BooleanType': 'BOOLEAN'}[type(x.dataType).__name__] } AS {x.name}" for x in MANIFEST.fields)


_GOOD = f"ext IN {_EXTRACTABLE}"


def _fresh(digest: str = "source_sha256") -> str:
    values = {
        "manifest_pos": "doc_id", "name": "name", "rel": "rel", "ext": "ext", "category": _CATEGORY, "size": "size",
        "quality": f"CASE WHEN {_GOOD} THEN {_JUDGE} WHEN ext = '.ppt' THEN 'needs_conversion' WHEN dup IS NOT NULL THEN 'skip_duplicate' ELSE 'unsupported' END",
        "unit": _UNIT, "count": f"CASE WHEN {_GOOD} THEN units END", "chars": f"CASE WHEN {_GOOD} THEN chars END", "raw": f"CASE WHEN {_GOOD} THEN {_raw('rel')} END",
        "raw_sha256": f"CASE WHEN {_GOOD} AND g % 9 <> 4 THEN CASE WHEN g % 9 = 5 THEN repeat('f', 64) ELSE {digest} END END",
        "source_sha256": f"CASE WHEN {_GOOD} OR dup IS NOT NULL THEN CASE WHEN g % 11 = 3 THEN repeat('e', 64) ELSE source_sha256 END END",
        "duplicate_of": "dup", "ocr": "CASE WHEN ext = '.pdf' AND g % 2 = 0 THEN true END", "converted": "CASE WHEN ext = '.pptx' AND g % 3 = 0 THEN true END",
    }
    return f"{_FILES}, fresh AS (SELECT {_fields(values)} FROM files)"


_FRESH, _FRESH_HAN = _fresh(), _fresh(f"sha256({_HAN_TEXT})")
_ARCHIVE = f"farch AS (SELECT {_raw('rel')} AS raw, text FROM files WHERE {_GOOD} AND g % 10 <> 1)"
_ARCHIVE_HAN = f"farch AS (SELECT {_raw('rel')} AS raw, {_HAN_TEXT} AS text FROM files WHERE {_GOOD} AND g % 10 <> 1)"
_LOCATED = f"""located AS (SELECT *, cat || coalesce('/' || sub, '') AS loc, cat || coalesce('/' || sub, '') || '/' || {_md("rel", "name")} AS path
 FROM (SELECT *, category AS cat, CASE WHEN category = '{rules.PLANNED}' THEN {_SUB} END AS sub FROM fresh WHERE quality IN ('text', 'sparse')))"""


def _keywords(source: str) -> str:
    """CTEs that end in kw(id, tags) for the rows (id, h) of ``source``."""
    stop = ", ".join(map(_s, han.STOP_WORDS))
    return f"""letters AS (SELECT id, string_split(h, '') AS c FROM {source}),
pairs AS (SELECT id, unnest(c) AS a, unnest(c[2:]) AS b, unnest(range(len(c))) AS i FROM letters),
ranked AS (SELECT id, w, row_number() OVER (PARTITION BY id ORDER BY n DESC, first) AS rk, n FROM (SELECT id, a || b AS w, count(*) AS n, min(i) AS first FROM pairs
 WHERE regexp_full_match(a || b, '[一-鿿]{{2}}') AND NOT regexp_matches(a || b, '[{han.STOP_CHARS}]') AND a || b NOT IN ({stop}) GROUP BY 1, 2) QUALIFY rk <= 24 AND n >= 4),
fold(id, rk, tags) AS (SELECT id, 0::BIGINT, []::VARCHAR[] FROM {source} UNION ALL
 SELECT f.id, f.rk + 1, CASE WHEN len(tags) < 6 AND NOT contains(array_to_string(tags, ''), w[1]) AND NOT contains(array_to_string(tags, ''), w[2]) THEN list_append(tags, w) ELSE tags END
 FROM fold f JOIN ranked r ON r.id = f.id AND r.rk = f.rk + 1),
kw AS (SELECT id, tags FROM fold QUALIFY row_number() OVER (PARTITION BY id ORDER BY rk DESC) = 1)"""


_LINES = r"string_split_regex({0}, '\r\n|[\n\r\x0B\x0C\x1C-\x1E\x{{85}}\x{{2028}}\x{{2029}}]')"


def _excerpt(x: str) -> str:
    rich = f"list_filter(list_transform({_LINES.format(x)}, lambda l: {_strip('l')}), lambda l: length(regexp_replace(l, '[^\\p{{L}}\\p{{Nl}}\\p{{No}}]', '', 'g')) >= 8)"
    return f"coalesce(left(regexp_replace({rich}[1], '\\s+', ' ', 'g'), 80), '')"


_LIBRARY = f"""lib0 AS (SELECT l.*, {_strip("coalesce(a.text, '')")} AS body FROM located l LEFT JOIN farch a ON a.raw = l.raw),
hs AS (SELECT manifest_pos AS id, body AS h FROM lib0), {_keywords("hs")},
lib AS (SELECT lib0.*, regexp_replace(name, '\\.[^.]*$', '') AS title, tags, {_excerpt("body")} AS excerpt,
 CASE WHEN ocr THEN 'x' WHEN quality = 'text' THEN '文字型' ELSE '稀疏' END AS lab FROM lib0 JOIN kw ON id = manifest_pos)"""


def _value(x: str) -> str:
    return f"(CASE WHEN {x} = '' OR regexp_matches({x}, '[:#\\[\\]{{}}\"''\\n|>&%@`*!,]') OR {_strip(x)} <> {x} THEN to_json({x})::VARCHAR ELSE {x} END)"


_MARKDOWN = f"""SELECT path, concat_ws(chr(10), '---', 'title: ' || {_value("title")}, 'source: ' || {_value("name")}, 'type: ' || ext[2:], 'category: ' || {_value("cat")}, 'subcategory: ' || {_value("sub")},
 unit || ': ' || "count", 'chars: ' || chars, 'quality: ' || {_value("CASE WHEN ocr THEN '文字型(OCR)' ELSE lab END")},
 CASE WHEN len(tags) > 0 THEN 'tags: [' || array_to_string(tags, ', ') || ']' END, CASE WHEN excerpt <> '' THEN 'excerpt: ' || {_value("excerpt")} END,
 CASE WHEN ocr THEN 'ocr: true' END, CASE WHEN converted THEN 'converted: true (LibreOffice)' END, '---', '',
 CASE WHEN ocr THEN '> 扫描页 OCR 识别,个别字可能有误,作参考土壤足够。' || chr(10) END, body) AS markdown FROM lib"""

_WAN = "CASE WHEN {0} >= 10000 THEN printf('%.1f', {0} / 10000.0::DOUBLE) || '万字' ELSE {0} || '字' END"
_CATALOG = f"""SELECT '- ' || concat_ws(' | ', replace(title, '|', '/'), loc, {_WAN.format("chars")} || CASE WHEN ocr THEN '·OCR' WHEN lab = '文字型' THEN '' ELSE '·' || lab END,
 CASE WHEN len(tags) > 0 THEN array_to_string(tags, ' ') ELSE '-' END, CASE WHEN excerpt <> '' THEN replace(excerpt, '|', '/') ELSE '-' END, path) AS line, manifest_pos FROM lib"""

_HANS = f"hs AS (SELECT doc_id AS id, {_HAN_TEXT} AS h FROM documents)"
_RADICALS = f"[{han.RADICALS}]"
_SCORES = f"""{_HANS}, ho AS (SELECT id, string_split(regexp_replace(h, '[^一-鿿]', '', 'g'), '') AS c, length(regexp_replace(h, '[^一-鿿]', '', 'g')) AS n,
 length(h) - length(regexp_replace(h, '{_RADICALS}', '', 'g')) AS rad FROM hs),
sc AS (SELECT id AS doc_id, n, rad / greatest(n, 1) AS radicals, len(list_filter(list_zip(c, c[2:]), lambda z: z[1] = z[2])) / greatest(n, 1) AS repeats FROM ho)"""
_FOLDED = "translate(h, '{}', '{}')".format(*han._foldings())
_REPAIRED = f"""{_HANS}, fo AS (SELECT id, h, string_split({_FOLDED}, '') AS c FROM hs),
ev AS (SELECT id, h, c, list_zip(c, list_prepend('', c)[:len(c)]) AS z FROM fo),
g AS (SELECT *, list_transform(list_filter(z, lambda x: x[1] = x[2] AND x[1] BETWEEN '一' AND '鿿'), lambda x: x[1]) AS again FROM ev),
o AS (SELECT *, list_filter(list_distinct(again), lambda x: len(list_filter(again, lambda y: y = x)) >= 3) AS often FROM g),
fixed AS (SELECT id, h, array_to_string(list_transform(list_filter(z, lambda x: NOT (x[1] = x[2] AND list_contains(often, x[1]))), lambda x: x[1]), '') AS t FROM o)"""

_PRIOR_VALUES = {
    "manifest_pos": "doc_id", "name": "name", "rel": "CASE WHEN b <> 3 THEN rel END", "ext": "ext", "category": f"CASE WHEN g % 7 = 2 THEN '手工类' ELSE {_CATEGORY} END",
    "size": "size + CASE WHEN b = 3 AND (g // 16) % 2 = 1 THEN 1 ELSE 0 END", "quality": "kind", "unit": f"CASE WHEN done THEN {_UNIT} END",
    "count": "CASE WHEN done THEN units END", "chars": "CASE WHEN done THEN chars END",
    "raw": f"CASE WHEN done THEN CASE WHEN b = 7 THEN '_raw/all/shared.txt' WHEN b = 3 AND (g // 16) % 3 = 0 THEN '_raw/all/' || name || '.txt' ELSE {_raw('rel')} END END",
    "raw_sha256": "CASE WHEN done AND b <> 4 THEN CASE b WHEN 2 THEN repeat('0', 64) WHEN 8 THEN sha256('') ELSE source_sha256 END END",
    "source_sha256": "CASE WHEN done OR kind = 'skip_duplicate' THEN CASE WHEN b = 1 THEN sha256('x' || text) WHEN b <> 3 THEN source_sha256 END END",
    "duplicate_of": "CASE WHEN kind = 'skip_duplicate' THEN dup END", "ocr": "CASE WHEN done AND b = 10 THEN true END", "garble_fixed": "CASE WHEN done AND b = 11 THEN true END",
    "converted": "CASE WHEN b = 12 AND ext = '.pptx' THEN true END",
}
_GONE = {"manifest_pos": "i + 1000000000", "name": "i || '.pdf'", "rel": "'gone/' || i || '.pdf'", "ext": "'.pdf'", "category": "'其他'", "quality": "'text'"}
_PLAN = f"""{_FILES}, kinds AS (SELECT *, g % 16 AS b, CASE WHEN g % 16 = 5 THEN 'failed' WHEN g % 16 = 6 THEN 'image' WHEN ext = '.ppt' THEN 'needs_conversion'
 WHEN ext = '.mobi' THEN CASE WHEN dup IS NOT NULL THEN 'skip_duplicate' ELSE 'unsupported' END WHEN ext = '.txt' THEN 'unsupported' ELSE 'text' END AS kind,
 {_GOOD} AND g % 16 NOT IN (5, 6) AS done FROM files),
prior AS (SELECT {_fields(_PRIOR_VALUES)} FROM kinds WHERE b <> 0 UNION ALL SELECT {_fields(_GONE)} FROM range(5) t(i)),
arch AS (SELECT raw, CASE WHEN b = 8 THEN '' ELSE text END AS text FROM prior JOIN kinds ON manifest_pos = doc_id WHERE raw IS NOT NULL AND b NOT IN (7, 9) UNION ALL SELECT '_raw/all/shared.txt', 'shared'),
shared AS (SELECT raw, count(*) AS n_raw FROM prior WHERE raw IS NOT NULL GROUP BY raw HAVING count(*) > 1),
old AS (SELECT coalesce(p.rel, p.name) AS key, p.*, n_raw, sha256(a.text) AS asha, strlen(a.text) AS abytes FROM prior p LEFT JOIN shared s ON s.raw = p.raw LEFT JOIN arch a ON a.raw = p.raw
 QUALIFY row_number() OVER (PARTITION BY coalesce(p.rel, p.name) ORDER BY p.manifest_pos DESC) = 1),
bound AS (SELECT f.*, CASE WHEN x.key IS NOT NULL THEN x ELSE y END AS o FROM files f LEFT JOIN old x ON x.key = f.rel
 LEFT JOIN (SELECT * FROM old WHERE rel IS NULL) y ON x.key IS NULL AND y.key = f.name AND y.ext = f.ext AND y.size = f.size),
st AS (SELECT *, o.key IS NOT NULL AS has, coalesce(o.raw IS NOT NULL AND (o.n_raw IS NOT NULL OR o.raw <> {_raw("bound.rel")}), false) AS refresh,
 coalesce(o.source_sha256 <> bound.source_sha256, false) AS changed,
 CASE WHEN o.quality IN ('failed', 'unsupported', 'needs_conversion') THEN false WHEN o.quality IN ('text', 'sparse') THEN
 coalesce(o.abytes, 0) > 0 AND (o.raw_sha256 IS NULL OR coalesce(o.asha = o.raw_sha256, false)) ELSE true END AS settled FROM bound),
kp AS (SELECT *, has AND NOT refresh AND NOT changed AND o.quality <> 'skip_duplicate' AND settled AS keep FROM st),
plan AS (SELECT *, CASE WHEN keep THEN 'keep' ELSE 'extract' END AS action, CASE WHEN NOT has THEN 'new' WHEN keep THEN 'kept'
 WHEN o.quality IN ('failed', 'unsupported', 'needs_conversion') OR refresh THEN 'retried' END AS counter FROM kp)"""

_MERGED_VALUES = {
    "manifest_pos": "pos", "name": "name", "rel": "rel", "ext": "ext", "category": f"coalesce(o.category, {_CATEGORY})", "size": "size",
    "quality": f"CASE WHEN ext = '.ppt' THEN 'needs_conversion' WHEN dup IS NOT NULL THEN 'skip_duplicate' WHEN bad THEN 'failed' WHEN good THEN {_JUDGE} ELSE 'unsupported' END",
    "unit": f"CASE WHEN good THEN {_UNIT} ELSE o.unit END", "count": "CASE WHEN good THEN units ELSE o.count END", "chars": "CASE WHEN good THEN chars ELSE o.chars END",
    "raw": f"CASE WHEN good THEN {_raw('rel')} WHEN ext = '.ppt' AND refresh THEN NULL ELSE o.raw END", "raw_sha256": "CASE WHEN good THEN source_sha256 END",
    "source_sha256": "CASE WHEN good OR dup IS NOT NULL THEN source_sha256 END",
    "note": "CASE WHEN ext = '.ppt' THEN '老格式PPT,需LibreOffice转换' WHEN dup IS NOT NULL THEN '与epub同书' WHEN ext = '.mobi' THEN 'mobi无epub版,未提取' ELSE o.note END",
    "error": "CASE WHEN bad THEN 'ValueError: broken' WHEN NOT good THEN o.error END", "duplicate_of": "CASE WHEN dup IS NOT NULL THEN dup ELSE o.duplicate_of END",
    "ocr": "CASE WHEN NOT good THEN o.ocr END", "converted": "CASE WHEN NOT (ext = '.ppt' AND refresh) THEN o.converted END",
    "garble_fixed": "CASE WHEN NOT good THEN o.garble_fixed END", "original_deleted": "o.original_deleted",
}
_KEPT = {x.name: "rel" if x.name == "rel" else f"o.{x.name}" for x in MANIFEST.fields}
_MERGED = f"""WITH {_PLAN}, ex AS (SELECT *, {_GOOD} AND g % 50 <> 7 AS good, {_GOOD} AND g % 50 = 7 AS bad,
 CASE WHEN has THEN o.manifest_pos ELSE (SELECT max(manifest_pos) + 1 FROM prior) + row_number() OVER (PARTITION BY has ORDER BY rel) - 1 END AS pos FROM plan)
SELECT {_fields(_KEPT)} FROM ex WHERE keep UNION ALL SELECT {_fields(_MERGED_VALUES)} FROM ex WHERE NOT keep
UNION ALL SELECT * FROM prior WHERE manifest_pos NOT IN (SELECT o.manifest_pos FROM plan WHERE has)"""


def _n(field: str, w: str) -> str:
    return f"((length({field}) - length(replace({field}, {_s(w)}, ''))) // {len(w)})::INT"


def _search(words: list[str], where: str = "true", columns: str = "path, score, why, quality", tail: str = "") -> str:
    counts = ", ".join(f"{_n('lt', w)} AS t{i}, {_n('lm', w)} AS m{i}, {_n('lb', w)} AS b{i}" for i, w in enumerate(words))
    score = " + ".join(f"5 * t{i} + 3 * greatest(m{i} - t{i}, 0) + least(b{i}, 10)" for i in range(len(words)))
    whys = []
    for i, w in enumerate(words):
        own = f"concat_ws(' ', CASE WHEN t{i} > 0 THEN '标题×' || t{i} END, CASE WHEN m{i} > t{i} THEN '标签摘要×' || (m{i} - t{i}) END, CASE WHEN b{i} > 0 THEN '正文×' || b{i} END)"
        whys.append(f"CASE WHEN t{i} > 0 OR m{i} > t{i} OR b{i} > 0 THEN {_s(w)} || '(' || {own} || ')' END" if len(words) > 1 else own)
    w = words[0]
    at = f"instr(lb, {_s(w)})"
    start = f"greatest(0, {at} - 26)"
    context = f"CASE WHEN b0 > 0 THEN '…' || {_strip(f"regexp_replace(substr(body, {start} + 1, {at} - 1 + {len(w) + 25} - {start}), '\\s+', ' ', 'g')")} || '…' ELSE '' END"
    return f"""WITH RECURSIVE {_FRESH}, {_ARCHIVE}, {_LOCATED}, {_LIBRARY},
noted AS (SELECT * REPLACE (CASE WHEN ocr THEN '> 扫描页 OCR 识别,个别字可能有误,作参考土壤足够。' || chr(10) || chr(10) || body ELSE body END AS body) FROM lib),
low AS (SELECT path, quality, body, lower(title) AS lt, lower(concat_ws(' ', title, array_to_string(tags, ', '), excerpt, name)) AS lm, lower(body) AS lb FROM noted WHERE {where}),
n AS (SELECT *, {counts} FROM low), hits AS (SELECT path, quality, {score} AS score, concat_ws(' ', {", ".join(whys)}) AS why, {context} AS context FROM n)
SELECT {columns} FROM hits WHERE score > 0 {tail}"""


_VERIFY = f"""{_FRESH_HAN}, {_ARCHIVE_HAN}, {_SCORES}, status AS (SELECT manifest_pos, name, CASE WHEN text IS NULL THEN 'noraw' WHEN coalesce(sha256(text) <> raw_sha256, true) THEN 'unverified'
 WHEN length({_strip("text")}) < {audit.SHORT_BODY} THEN 'empty' WHEN n >= 50 AND (radicals > 0.03 OR repeats > 0.06) THEN 'garbled' ELSE 'ok' END AS status,
 coalesce(ocr, false) AND "count" >= 20 AND chars < "count" * 50 AS short FROM fresh LEFT JOIN farch USING (raw) JOIN sc ON doc_id = manifest_pos WHERE quality IN ('text', 'sparse'))"""
_REMOVAL = f"""{_FRESH}, {_ARCHIVE}, m AS (SELECT f.*, coalesce(f.source_sha256 = n.source_sha256, false) AS same,
 coalesce(f.source_sha256 = n.source_sha256 AND f.quality IN ('text', 'sparse') AND length(f.raw_sha256) = 64 AND strlen(a.text) > 10 AND sha256(a.text) = f.raw_sha256, false) AS proven
 FROM (SELECT * FROM fresh QUALIFY row_number() OVER (PARTITION BY rel ORDER BY manifest_pos DESC) = 1) f LEFT JOIN farch a ON a.raw = f.raw LEFT JOIN files n ON n.rel = f.rel),
removal AS (SELECT m.manifest_pos, m.size, CASE WHEN m.quality = 'skip_duplicate' THEN CASE WHEN m.same AND coalesce(t.proven, false) THEN 'delete' ELSE 'no_archive' END
 WHEN m.quality IN ('text', 'sparse') THEN CASE WHEN m.proven THEN 'delete' ELSE 'no_archive' END ELSE 'keep' END AS decision FROM m LEFT JOIN m t ON t.rel = m.duplicate_of)"""
_PATHS = f"""{_FRESH}, {_LOCATED}, paths AS (SELECT path FROM located WHERE manifest_pos % 17 <> 0 UNION ALL SELECT '其他/orphan_' || i || '.md' FROM range(4) t(i)
 UNION ALL SELECT unnest(['INDEX.md', '手工/own.md', '其他/figure.png']))"""
_DIRTY = "CASE WHEN doc_id % 3 = 0 THEN chr(1) || chr(13) || chr(11) || chr(65533) || text ELSE text END"
_CLEAN = f"regexp_replace({_DIRTY}, '[\\x00-\\x08\\x0B-\\x1F\\x{{FFFD}}\\x{{FFFF}}]', '', 'g')"
_UNTAGGED = "regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>', '', 'g'), '(?s)<[^>]+>', ' ', 'g')"
_DECODED = _UNTAGGED
for _ref, _char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
    _DECODED = f"regexp_replace({_DECODED}, '&{_ref};?', '{_char}', 'g')"

_READ = "quality = 'image' AND ext = '.pdf' AND NOT coalesce(ocr, false) AND g % 7 <> 6 AND g % 5 <> 4"
_OCR_VALUES = {
    "raw": f"CASE WHEN hit THEN {_raw('rel')} ELSE raw END", "raw_sha256": "CASE WHEN hit THEN own_sha256 ELSE raw_sha256 END", "source_sha256": "CASE WHEN hit THEN own_sha256 ELSE source_sha256 END",
    "chars": "CASE WHEN hit THEN ocr_chars ELSE chars END", "quality": "CASE WHEN hit THEN 'text' ELSE quality END", "ocr": "CASE WHEN hit THEN true ELSE ocr END",
    "count": "CASE WHEN hit THEN units ELSE \"count\" END",
}
_OCR = f"""WITH {_FRESH}, x AS (SELECT fresh.*, g, units, sha256(text) AS own_sha256, length({_strip('replace(text, chr(10), {0})'.format(_s("")))})::INT AS ocr_chars FROM fresh JOIN files ON doc_id = manifest_pos),
y AS (SELECT *, {_READ} AS hit FROM x) SELECT {_fields({**{f.name: f'"{f.name}"' for f in MANIFEST.fields}, **_OCR_VALUES})} FROM y"""
_SLIDES = "CASE WHEN all_chars / units >= 60 THEN 'text' WHEN all_chars / units >= 12 THEN 'sparse' ELSE 'image' END"
_CONVERTED_VALUES = {
    "raw": f"CASE WHEN good THEN {_raw('rel')} ELSE raw END", "raw_sha256": "CASE WHEN good THEN own_sha256 ELSE raw_sha256 END", "source_sha256": "CASE WHEN good THEN own_sha256 ELSE source_sha256 END",
    "chars": "CASE WHEN good THEN all_chars ELSE chars END", "quality": f"CASE WHEN good THEN {_SLIDES} WHEN ext = '.ppt' THEN 'failed' ELSE quality END", "unit": "CASE WHEN good THEN 'slides' ELSE unit END",
    "converted": "CASE WHEN good THEN true ELSE converted END", "error": "CASE WHEN ext = '.ppt' AND NOT good THEN 'RuntimeError: broken' END", "count": "CASE WHEN good THEN units ELSE \"count\" END",
}
_CONVERTED = f"""WITH {_FRESH}, x AS (SELECT fresh.*, units, files.chars AS all_chars, sha256(text) AS own_sha256, fresh.ext = '.ppt' AND g % 5 <> 4 AS good FROM fresh JOIN files ON doc_id = manifest_pos)
SELECT {_fields({**{f.name: f'"{f.name}"' for f in MANIFEST.fields}, **_CONVERTED_VALUES})} FROM x"""

ORACLES = {
    "clean_text": f"SELECT doc_id, {_CLEAN} AS text, length({_strip(_CLEAN)})::INT AS chars, length({_strip(f'replace({_CLEAN}, chr(10), {_s("")})')})::INT AS ocr_chars FROM documents",
    "type_histogram": f"WITH {_FILES} SELECT ext, count(*) AS n FROM files GROUP BY ext",
    "quality_judge": f"WITH {_FILES} SELECT doc_id, units, {_JUDGE} AS quality FROM files",
    "classify_docs": f"WITH {_FILES} SELECT doc_id, name, {_CATEGORY} AS category FROM files",
    "subcategory_docs": f"WITH {_FILES} SELECT doc_id, {_CATEGORY} || CASE WHEN {_CATEGORY} = '{rules.PLANNED}' THEN '/' || {_SUB} ELSE '' END AS loc FROM files",
    "quality_by_category": f"WITH {_FRESH} SELECT quality, category, count(*) AS n FROM fresh GROUP BY ALL",
    "html_to_text": f"SELECT page_id, regexp_replace(regexp_replace(regexp_replace({_DECODED}, '[\\x00-\\x08\\x0B-\\x1F]', '', 'g'), '[ \\t]{{2,}}', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g') AS text FROM pages",
    "excerpt": f"SELECT doc_id, {_excerpt('text')} AS excerpt FROM documents",
    "han_keywords": f"WITH RECURSIVE {_HANS}, {_keywords('hs')} SELECT id AS doc_id, array_to_string(tags, ' ') AS keywords FROM kw",
    "garble_score": f"WITH {_SCORES} SELECT doc_id, n::INT AS n_han, round(radicals, 9) AS radicals, round(repeats, 9) AS repeats FROM sc",
    "garble_flagged": f"WITH {_SCORES} SELECT doc_id FROM sc WHERE n >= 50 AND (radicals > 0.03 OR repeats > 0.06)",
    "garble_repaired": f"WITH {_REPAIRED} SELECT id AS doc_id, t <> h AS changed, sha256(t) AS sha256 FROM fixed",
    "radical_norm": f"WITH {_HANS} SELECT id AS doc_id, sha256({_FOLDED}) AS sha256 FROM hs",
    "front_matter": f"WITH RECURSIVE {_FRESH_HAN}, {_ARCHIVE_HAN}, {_LOCATED}, {_LIBRARY} {_MARKDOWN}",
    "size_label": f"SELECT doc_id, {_WAN.format('(n_chars * 10)')} AS label FROM documents",
    "raw_names": f"WITH {_FILES} SELECT doc_id, {_raw('rel')}[10:] AS raw, replace(rel, '/', '__') AS flat FROM files",
    "md_names": f"WITH {_FILES}, o AS (SELECT doc_id, name, CASE WHEN doc_id % 10 <> 9 THEN rel END AS old FROM files) SELECT doc_id, {_md('old', 'name')} AS md, coalesce(old, name) AS key FROM o",
    "path_validity": f"SELECT doc_id, (doc_id % {len(PREFIXES)}) IN (0, 9, 10, 11) AS safe FROM documents",
    "text_fingerprints": "SELECT doc_id, sha256(text) AS sha256 FROM documents",
    "mobi_epub_dedup": f"WITH {_FILES} SELECT rel, dup AS duplicate_of FROM files WHERE dup IS NOT NULL",
    "incremental_plan": f"WITH {_PLAN} SELECT rel, action, counter, has AND refresh AS refresh_raw, dup AS duplicate_of FROM plan",
    "incremental_counts": f"WITH {_PLAN} SELECT count(*) FILTER (counter = 'new') AS n_new, count(*) FILTER (counter = 'kept') AS n_kept, count(*) FILTER (counter = 'retried') AS n_retried, count(*) FILTER (counter IS NULL) AS n_again, count(*) AS n_sources FROM plan",
    "merged_manifest": _MERGED,
    "catalog": f"WITH RECURSIVE {_FRESH_HAN}, {_ARCHIVE_HAN}, {_LOCATED}, {_LIBRARY} {_CATALOG} ORDER BY loc, chars DESC, manifest_pos",
    "index_counts": f"WITH {_FRESH}, {_LOCATED} SELECT category, sub, count(*) AS n, count(*) FILTER (ocr) AS ocr_n FROM located GROUP BY category, sub",
    "quality_report": f"WITH {_FRESH}, s AS (SELECT count(*) AS total, count(*) FILTER (quality IN ('text', 'sparse')) AS usable FROM fresh) SELECT quality, count(*) AS n, total, usable, usable * 100 // greatest(total, 1) AS percent FROM fresh, s GROUP BY quality, total, usable",
    "report_sections": f"WITH {_FRESH} SELECT quality, category, name, coalesce(chars::VARCHAR, '?') AS chars_shown, coalesce(chars, 0)::INT AS chars, manifest_pos FROM fresh WHERE quality IN ('image', 'needs_conversion', 'failed', 'unsupported')",
    "search_topk": _search(["que", "der"], tail="ORDER BY score DESC, path LIMIT 10"),
    "search_context": _search(["the"], columns="path, score, context"),
    "search_category": _search(["the", "方案"], where="starts_with(path, '营销策划')", columns="path, score, why"),
    "search_nothing": _search(["zzzznotfound"], columns="path, score"),
    "verify_status": f"WITH {_VERIFY} SELECT manifest_pos, name, status, short AND status = 'ok' AS short_book FROM status",
    "verify_counts": f"WITH {_VERIFY} SELECT count(*) FILTER (status <> 'noraw') AS checked, {', '.join(f"count(*) FILTER (status = '{x}') AS {x}" for x in ('ok', 'empty', 'garbled', 'noraw', 'unverified'))}, count(*) FILTER (short AND status = 'ok') AS short_book, count(*) FILTER (status <> 'ok' OR short) = 0 AS healthy FROM status",
    "garble_repair_records": f"WITH {_FRESH_HAN}, {_ARCHIVE_HAN}, {_SCORES}, {_REPAIRED.removeprefix(_HANS + ', ')} SELECT manifest_pos, length({_strip('t')})::INT AS chars, sha256(t) AS raw_sha256, true AS garble_fixed FROM fresh JOIN farch USING (raw) JOIN sc ON doc_id = manifest_pos JOIN fixed ON id = manifest_pos WHERE quality IN ('text', 'sparse') AND sha256(text) = raw_sha256 AND n >= 50 AND (radicals > 0.03 OR repeats > 0.06)",
    "missing_md": f"WITH {_PATHS} SELECT path FROM located WHERE path NOT IN (SELECT path FROM paths)",
    "orphan_md": f"WITH {_PATHS} SELECT path FROM paths WHERE path LIKE '%.md' AND split_part(path, '/', 1) IN (SELECT category FROM fresh) AND path NOT IN (SELECT path FROM located)",
    "library_consistency": f"WITH {_PATHS} SELECT true AS built, (SELECT count(*) FROM located WHERE path NOT IN (SELECT path FROM paths)) AS n_missing, (SELECT count(*) FROM paths WHERE path LIKE '%.md' AND split_part(path, '/', 1) IN (SELECT category FROM fresh) AND path NOT IN (SELECT path FROM located)) AS n_orphans",
    "at_stake": f"WITH {_FRESH} SELECT count(*) FILTER (quality = 'image') AS n_images, count(*) FILTER (quality = 'failed') AS n_failed FROM fresh",
    "search_notes": _search(["ocr"], columns="path, score, context"),
    "cleanup_plan": f"WITH {_REMOVAL} SELECT manifest_pos, decision, size FROM removal",
    "cleanup_bytes": f"WITH {_REMOVAL} SELECT decision, count(*) AS n, sum(size)::BIGINT AS bytes, CASE WHEN sum(size) > 1e9 THEN printf('%.2f', sum(size)::DOUBLE / 1073741824) || 'GB' ELSE printf('%.0f', sum(size)::DOUBLE / 1048576) || 'MB' END AS label FROM removal GROUP BY decision",
    "ocr_sample_pages": f"WITH {_FILES} SELECT doc_id, array_to_string(list_sort(list_distinct([least(2, units - 1), units // 5, units // 2, units * 4 // 5])), ' ') AS pages FROM files",
    "ocr_applied": _OCR,
    "conversion_candidates": f"WITH {_FRESH} SELECT manifest_pos, rel FROM fresh WHERE quality = 'needs_conversion'",
    "conversion_applied": _CONVERTED,
    "run_counts": f"WITH {_PLAN} SELECT count(*) FILTER (counter = 'new') AS n_new, count(*) FILTER (counter = 'kept') AS n_kept, count(*) FILTER (counter = 'retried') AS n_retried, count(*) FILTER (counter IS NULL) AS n_again, count(*) AS n_sources, count(*) FILTER (NOT keep AND {_GOOD} AND g % 50 = 7) AS n_failed FROM plan",
    "ocr_book_judge": f"SELECT conv_id, round(avg(length({_strip("coalesce(text, '')")})), 6) AS mean, avg(length({_strip("coalesce(text, '')")})) >= 150 AS is_book FROM conversations GROUP BY conv_id",
    "manifest_log": f"SELECT * FROM ({_MERGED}) WHERE quality IS DISTINCT FROM 'failed'",
    "garble_applied": f"""WITH {_FRESH_HAN}, {_ARCHIVE_HAN}, {_SCORES}, {_REPAIRED.removeprefix(_HANS + ', ')},
rep AS (SELECT manifest_pos, t FROM fresh JOIN farch USING (raw) JOIN sc ON doc_id = manifest_pos JOIN fixed ON id = manifest_pos
 WHERE quality IN ('text', 'sparse') AND sha256(text) = raw_sha256 AND n >= 50 AND (radicals > 0.03 OR repeats > 0.06) AND (manifest_pos // 8) % 6 <> 0)
SELECT f.manifest_pos, CASE WHEN t IS NULL THEN f.chars ELSE length({_strip('t')})::INT END AS chars, CASE WHEN t IS NULL THEN f.raw_sha256 ELSE sha256(t) END AS raw_sha256,
 CASE WHEN t IS NOT NULL THEN true ELSE f.garble_fixed END AS garble_fixed, sha256(coalesce(t, CASE WHEN (f.manifest_pos // 8) % 6 = 0 THEN a.text || 'x' ELSE a.text END)) AS archive_sha256
FROM fresh f LEFT JOIN farch a ON a.raw = f.raw LEFT JOIN rep ON rep.manifest_pos = f.manifest_pos""",
    "removal_recovered": f"WITH {_REMOVAL} SELECT f.manifest_pos, CASE WHEN r.decision = 'delete' AND f.manifest_pos % 2 = 0 THEN true ELSE f.original_deleted END AS original_deleted FROM fresh f LEFT JOIN removal r ON r.manifest_pos = f.manifest_pos",
    "search_indexed": _search(["que", "der"], tail="ORDER BY score DESC, path LIMIT 10"),
    "classify_table": f"""WITH w AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS k FROM documents), r AS (SELECT k, ('0x' || md5(k)[1:6])::BIGINT % {fx.WORD_RULES} AS p FROM w WHERE length(k) >= {fx.WORD_LETTERS})
SELECT item_id, coalesce('R' || min(p), {_s(rules.OTHER)}) AS category FROM benchmark LEFT JOIN r ON contains(lower(text), k) GROUP BY item_id""",
}
