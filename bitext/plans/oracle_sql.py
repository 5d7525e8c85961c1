"""Independent DuckDB SQL for each registered query (the correctness oracle).

Written from the operator definitions, not from the Spark code: DuckDB's RE2
has no look-behind and ASCII ``\\s``, so patterns are restated for it. The
fixture text has no mojibake markers, CJK or non-ASCII spaces, so the SQL
cleaning omits those branches; ``mojibake_repair`` injects such defects and states
what must come of them.
"""

from __future__ import annotations

from ..operators.split import _SEP  # noqa: F401  (documented: U+001F)
from .fixtures import DEMO_GLOSSARY, EVENT_MODES, GBK_READ, LINE_STRIDE

SEED = 42
TRAIN, VALID = 0.7, 0.15
T1 = format(int(TRAIN * 16 ** 8), "08x")
T2 = format(int((TRAIN + VALID) * 16 ** 8), "08x")
TV = repr(TRAIN + VALID)


def _norm(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '\\s+', ' ', 'g'))"


def _ntok(x: str) -> str:
    return f"CASE WHEN {x} = '' THEN 0 ELSE len(string_split({x}, ' ')) END"


RAW_PAIRS = f"""
raw_pairs AS (
  SELECT doc_id::HUGEINT * {LINE_STRIDE} + i AS line_no,
         CASE WHEN doc_id % 7 = 0 THEN '_' || lines[i] ELSE lines[i] END AS source,
         coalesce(lines[i + 1], '') || CASE WHEN doc_id % 5 = 0 THEN chr(13) ELSE '' END AS target
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))
)"""

CONV_PAIRS = f"""
raw_pairs AS (
  SELECT u.conv_id::HUGEINT * {LINE_STRIDE} + u.turn AS line_no, u.text AS source, coalesce(a.text, '') AS target
  FROM conversations u LEFT JOIN conversations a
    ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
)"""


def _keep(s: str, t: str) -> str:
    ns, nt = _ntok(s), _ntok(t)
    return (f"(({ns}) >= 2 AND ({nt}) >= 2 AND ({ns}) <= 80 AND ({nt}) <= 80 "
            f"AND least({ns}, {nt}) > 0 AND greatest({ns}, {nt})::DOUBLE <= 3.0 * least({ns}, {nt}))")


CLEANED = """
cleaned0 AS (
  SELECT line_no, source AS raw_s, target AS raw_t,
         replace(trim(regexp_replace(regexp_replace(coalesce(source, ''), '[\\x00-\\x08\\x0A-\\x1F]', '', 'g'), '\\s+', ' ', 'g')), '_', '') AS source,
         replace(trim(regexp_replace(regexp_replace(coalesce(target, ''), '[\\x00-\\x08\\x0A-\\x1F]', '', 'g'), '\\s+', ' ', 'g')), '_', '') AS target
  FROM raw_pairs
),
cleaned AS (
  SELECT *,
         NOT (source IS NOT DISTINCT FROM raw_s AND target IS NOT DISTINCT FROM raw_t) AS modified,
         (source <> '' AND target <> '' AND lower(source) NOT IN ('translator-credits', 'n/a')
          AND length(source) >= 2 AND length(target) >= 2
          AND NOT (source = target AND length(source) <= 3)) AS valid
  FROM cleaned0
)"""

LOADED = f"""
loaded AS (
  SELECT line_no, {_norm('source')} AS source, {_norm('target')} AS target FROM raw_pairs
  WHERE {_norm('source')} <> '' AND {_norm('target')} <> ''
)"""


def _exact_split(src: str) -> str:
    return f"""
keyed AS (
  SELECT *, md5(concat_ws(chr(31), '{SEED}', source, target, CAST(line_no AS VARCHAR))) AS split_key
  FROM {src}
),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY split_key, line_no) - 1 AS rk, count(*) OVER () AS n FROM keyed
),
cuts AS (
  SELECT *, greatest(1, floor(n::DOUBLE * {TRAIN!r}::DOUBLE)::BIGINT) AS te FROM ranked
),
split AS (
  SELECT line_no, source, target, split_key,
         CASE WHEN rk < te THEN 'train'
              WHEN rk < greatest(te + 1, floor(n::DOUBLE * {TV}::DOUBLE)::BIGINT) THEN 'valid'
              ELSE 'test' END AS split
  FROM cuts
)"""


PREPARED = f"""
prepared_in AS (
  SELECT min(line_no) AS line_no, {_norm('source')} AS source, {_norm('target')} AS target
  FROM cleaned GROUP BY cleaned.source, cleaned.target
  HAVING bool_or(valid) AND bool_or({_norm('source')} <> '' AND {_norm('target')} <> ''
                                     AND {_keep(_norm('source'), _norm('target'))})
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


ORACLES: dict[str, str] = {}

ORACLE_PREP = _with(RAW_PAIRS, CLEANED, PREPARED, _exact_split("prepared_in"))

ORACLES["pairs_clean"] = _with(RAW_PAIRS, CLEANED) + """
SELECT min(line_no) AS line_no, source, target FROM cleaned WHERE valid GROUP BY source, target"""

ORACLES["clean_audit"] = _with(RAW_PAIRS, CLEANED) + """
SELECT coalesce(sum(n), 0)::BIGINT AS input_rows,
       (count(*) FILTER (WHERE valid))::BIGINT AS output_rows,
       coalesce(sum(n_modified), 0)::BIGINT AS modified_rows,
       coalesce(sum(n) FILTER (WHERE NOT valid), 0)::BIGINT AS dropped_invalid,
       coalesce(sum(n - 1) FILTER (WHERE valid), 0)::BIGINT AS dropped_dup
FROM (SELECT source, target, count(*) AS n, count(*) FILTER (WHERE modified) AS n_modified,
             bool_or(valid) AS valid
      FROM cleaned GROUP BY source, target)"""

ORACLES["keep_pairs"] = _with(RAW_PAIRS, LOADED) + f"""
SELECT line_no, source, target FROM loaded WHERE {_keep('source', 'target')}"""

ORACLES["token_counts"] = _with(RAW_PAIRS) + """
SELECT line_no, len(regexp_extract_all(source, '\\S+'))::INTEGER AS src_tokens,
       len(regexp_extract_all(target, '\\S+'))::INTEGER AS tgt_tokens
FROM raw_pairs"""

ORACLES["split_exact"] = _with(RAW_PAIRS, LOADED, _exact_split("loaded")) + """
SELECT * FROM split"""

ORACLES["split_hash"] = _with(RAW_PAIRS, LOADED) + f"""
SELECT line_no, source, target, k AS split_key,
       CASE WHEN substr(k, 1, 8) < '{T1}' THEN 'train'
            WHEN substr(k, 1, 8) < '{T2}' THEN 'valid' ELSE 'test' END AS split
FROM (SELECT *, md5(concat_ws(chr(31), '{SEED}', source, target)) AS k FROM loaded)"""

ORACLES["split_counts"] = _with(
    RAW_PAIRS, LOADED,
    f"\nkept AS (SELECT * FROM loaded WHERE {_keep('source', 'target')})",
    _exact_split("kept")) + """
SELECT 'loaded' AS metric, (SELECT count(*) FROM loaded)::BIGINT AS value
UNION ALL SELECT 'dropped_by_filter', ((SELECT count(*) FROM loaded) - (SELECT count(*) FROM kept))::BIGINT
UNION ALL SELECT split, count(*)::BIGINT FROM split GROUP BY split"""

ORACLES["prepare_corpus"] = ORACLE_PREP + """
SELECT * FROM split"""

ORACLES["corpus_summary"] = ORACLE_PREP + f"""
SELECT split, count(*)::BIGINT AS pairs, sum({_ntok('source')})::BIGINT AS src_tokens,
       sum({_ntok('target')})::BIGINT AS tgt_tokens
FROM split GROUP BY split"""

ORACLES["conversation_corpus"] = _with(CONV_PAIRS, CLEANED, PREPARED, _exact_split("prepared_in")) + """
SELECT * FROM split"""


# --- sentences, glossary, memory, translation --------------------------------

def _segment(src: str, text: str, keep: str) -> str:
    """Rows ``(keep..., pos, sentence)`` of ``src``: split after . ! ? + spaces
    or on line breaks, trim, drop empties."""
    return f"""
  SELECT {keep}, unnest(range(len(parts)))::INTEGER AS pos, unnest(parts) AS sentence
  FROM (SELECT {keep},
               list_filter(list_transform(
                 regexp_split_to_array(regexp_replace(trim({text}), '([.!?])\\s+', '\\1' || chr(10), 'g'),
                                       '\\r?\\n+'),
                 lambda x: trim(x)), lambda x: x <> '') AS parts
        FROM {src})"""


SENTENCES = f"\nsentences AS ({_segment('documents', 'text', 'doc_id, lang')}\n)"
MEMORY = f"""
bench_sent AS ({_segment('benchmark', 'text', 'item_id')}
),
memory AS (SELECT DISTINCT sentence AS source, '[tm] ' || sentence AS translation FROM bench_sent)"""


def _re2_escape(term: str) -> str:
    return "".join("\\" + ch if ch in ".^$*+?()[]{}|\\" else ch for ch in term)


def _sorted_glossary():
    items = sorted(DEMO_GLOSSARY, key=lambda r: r[0])
    items.sort(key=lambda r: -len(r[1]))
    return [(s, t) for _, s, t in items]


GLOSSARY = _sorted_glossary()


def _protect_ctes(src: str, text: str, keys: str) -> str:
    """CTEs p0..pN; pN has ``keys, t`` (protected text) and flags m0..m(N-1)."""
    ctes = [f"\np0 AS (SELECT {keys}, {text} AS t FROM {src})"]
    flags: list[str] = []
    for i, (term, _t) in enumerate(GLOSSARY):
        pat = _re2_escape(term).replace("'", "''")
        prev = ", ".join(flags)
        carry = (prev + ", ") if prev else ""
        ctes.append(f"\np{i + 1} AS (SELECT {keys}, {carry}regexp_matches(t, '{pat}', 'i') AS m{i}, "
                    f"regexp_replace(t, '{pat}', '__TERM_{i}__', 'gi') AS t FROM p{i})")
        flags.append(f"m{i}")
    return ",".join(ctes)


def _restore(expr: str) -> str:
    for i, (_s, target) in enumerate(GLOSSARY):
        expr = f"replace({expr}, '__TERM_{i}__', '{target}')"
    return expr


def _terms_text() -> str:
    parts = [f"CASE WHEN m{i} THEN '__TERM_{i}__={t}' END" for i, (_s, t) in enumerate(GLOSSARY)]
    return "concat_ws('|', " + ", ".join(parts) + ")"


def _reverse(x: str) -> str:
    return f"array_to_string(list_reverse(string_split({x}, ' ')), ' ')"


PN = f"p{len(GLOSSARY)}"

ORACLES["sentences"] = _with(SENTENCES) + """
SELECT doc_id, pos, sentence FROM sentences"""

ORACLES["glossary_protect"] = _with(SENTENCES, _protect_ctes("sentences", "sentence", "doc_id, pos")) + f"""
SELECT doc_id, pos, t AS protected, {_terms_text()} AS terms FROM {PN}"""

ORACLES["glossary_restore"] = _with(SENTENCES, _protect_ctes("sentences", "sentence", "doc_id, pos")) + f"""
SELECT doc_id, pos, {_restore('t')} AS restored FROM {PN}"""

ORACLES["memory_lookup"] = _with(SENTENCES, MEMORY) + """
SELECT s.doc_id, s.pos, s.sentence, m.translation AS memory_translation, m.source IS NOT NULL AS hit
FROM sentences s LEFT JOIN memory m ON m.source = s.sentence"""

PENDING = """
pending AS (SELECT DISTINCT sentence FROM sentences s
            WHERE NOT EXISTS (SELECT 1 FROM memory m WHERE m.source = s.sentence))"""

ORACLES["memory_pending"] = _with(SENTENCES, MEMORY, PENDING) + """
SELECT sentence FROM pending"""

STATS_SQL = """
SELECT (SELECT count(*) FROM sentences)::BIGINT AS positions,
       ((SELECT count(*) FROM sentences) - (SELECT count(*) FROM pending))::BIGINT AS hits,
       (SELECT count(*) FROM pending)::BIGINT AS pending"""

ORACLES["cache_hits"] = _with(SENTENCES, MEMORY, PENDING) + STATS_SQL

ORACLES["memory_upsert"] = _with(SENTENCES, MEMORY, PENDING) + f"""
SELECT source, translation FROM memory
UNION ALL SELECT sentence, {_reverse('sentence')} FROM pending"""

FRESH = ",".join([_protect_ctes("pending", "sentence", "sentence"),
                  f"\nfresh AS (SELECT sentence, {_restore(_reverse('t'))} AS translation FROM {PN})"])

ORACLES["translate_docs"] = _with(SENTENCES, MEMORY, PENDING, FRESH) + """
SELECT s.doc_id, s.pos, s.sentence,
       CASE WHEN m.source IS NOT NULL THEN m.translation ELSE f.translation END AS translation,
       m.source IS NOT NULL AS hit
FROM sentences s LEFT JOIN memory m ON m.source = s.sentence
LEFT JOIN fresh f ON f.sentence = s.sentence"""

ORACLES["translate_stats"] = _with(SENTENCES, MEMORY, PENDING) + STATS_SQL

ORACLES["translate_memory"] = _with(SENTENCES, MEMORY, PENDING, FRESH) + """
SELECT source, translation FROM memory
UNION ALL SELECT sentence AS source, translation FROM fresh"""

ORACLES["translate_nocache"] = _with(SENTENCES) + f"""
SELECT doc_id, pos, sentence, {_reverse('sentence')} AS translation, false AS hit FROM sentences"""

ORACLES["translated_documents"] = _with(SENTENCES, MEMORY, PENDING, FRESH) + """
SELECT doc_id, string_agg(coalesce(translation, ''), chr(10) ORDER BY pos) AS translation
FROM (SELECT s.doc_id, s.pos,
             CASE WHEN m.source IS NOT NULL THEN m.translation ELSE f.translation END AS translation
      FROM sentences s LEFT JOIN memory m ON m.source = s.sentence
      LEFT JOIN fresh f ON f.sentence = s.sentence)
GROUP BY doc_id"""

# --- BLEU -----------------------------------------------------------------------

def _tok13a(x: str) -> str:
    e = f"regexp_replace({x}, '\\s+$', '')"
    for a, b in (("<skipped>", ""), ("-' || chr(10) || '", ""), ("' || chr(10) || '", " ")):
        e = f"replace({e}, '{a}', '{b}')"
    for a, b in (("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        e = f"replace({e}, '{a}', '{b}')"
    e = f"(' ' || {e} || ' ')"
    rules = ((r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", r" \1 "), (r"([^0-9])([\.,])", r"\1 \2 "),
             (r"([\.,])([^0-9])", r" \1 \2"), (r"([0-9])(-)", r"\1 \2 "))
    for pat, rep in rules:
        e = f"regexp_replace({e}, '{pat}', '{rep}', 'g')"
    return (f"(CASE WHEN trim({e}) = '' THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array(trim({e}), '\\s+') END)")


SYSTEMS = ",".join([
    SENTENCES,
    _protect_ctes("sentences", "sentence", "doc_id, pos, lang, sentence"),
    f"""
systems AS (
  SELECT doc_id, pos, lang, 'baseline' AS system, {_reverse('sentence')} AS hyp, sentence AS ref FROM sentences
  UNION ALL
  SELECT doc_id, pos, lang, 'finetuned', {_restore('t')}, sentence FROM {PN}
),
toks AS (SELECT doc_id, pos, lang, system, {_tok13a('hyp')} AS h, {_tok13a('ref')} AS r FROM systems),
orders AS (SELECT unnest([1, 2, 3, 4]) AS n),
grams AS (
  SELECT system, lang, doc_id, pos, n, 1 AS hc, 0 AS rc,
         unnest(list_transform(range(1, len(h) - n + 2), lambda i: array_to_string(h[i:i + n - 1], ' '))) AS gram
  FROM toks, orders WHERE len(h) >= n
  UNION ALL
  SELECT system, lang, doc_id, pos, n, 0, 1,
         unnest(list_transform(range(1, len(r) - n + 2), lambda i: array_to_string(r[i:i + n - 1], ' ')))
  FROM toks, orders WHERE len(r) >= n
),
per_gram AS (SELECT system, lang, doc_id, pos, n, gram, sum(hc) AS h, sum(rc) AS r
             FROM grams GROUP BY ALL)"""])


def _stats_select(group: str) -> str:
    cols = []
    for n in range(1, 5):
        cols.append(f"coalesce(sum(least(h, r)) FILTER (WHERE n = {n}), 0)::BIGINT AS correct_{n}")
    for n in range(1, 5):
        cols.append(f"coalesce(sum(h) FILTER (WHERE n = {n}), 0)::BIGINT AS total_{n}")
    cols.append("coalesce(sum(h) FILTER (WHERE n = 1), 0)::BIGINT AS sys_len")
    cols.append("coalesce(sum(r) FILTER (WHERE n = 1), 0)::BIGINT AS ref_len")
    return f"SELECT {group}, " + ", ".join(cols) + f" FROM per_gram GROUP BY {group}"


def _bleu_expr() -> str:
    zs, logs = [], []
    for n in range(1, 5):
        zs.append(f"(correct_{n} = 0)::INTEGER")
        z = " + ".join(zs)
        logs.append(f"ln(CASE WHEN correct_{n} = 0 THEN 100.0 / (pow(2.0, {z}) * total_{n}) "
                    f"ELSE 100.0 * correct_{n} / total_{n} END)")
    bp = "(CASE WHEN sys_len >= ref_len THEN 1.0 ELSE exp(1.0 - ref_len::DOUBLE / sys_len::DOUBLE) END)"
    return (f"(CASE WHEN total_4 = 0 OR sys_len = 0 "
            f"OR correct_1 + correct_2 + correct_3 + correct_4 = 0 THEN 0.0 "
            f"ELSE {bp} * exp(({' + '.join(logs)}) / 4.0) END)")


ORACLES["bleu_by_lang"] = _with(SYSTEMS) + f"""
SELECT *, round({_bleu_expr()}, 6) AS bleu FROM ({_stats_select('system, lang')})"""

ORACLES["evaluate_systems"] = _with(SYSTEMS) + f"""
SELECT *, round({_bleu_expr()}, 6) AS bleu FROM ({_stats_select('system')})"""

ORACLES["align_lines"] = _with(RAW_PAIRS) + f"""
SELECT line_no, {_reverse('source')} AS hypothesis, target AS reference FROM raw_pairs"""

# --- runs and reports ------------------------------------------------------------

_MODE_CASE = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in EVENT_MODES.items()) + " END"

RUNS = f"""
runs AS (
  SELECT event_id AS row_no, {_MODE_CASE} AS mode,
         CASE WHEN user_id % 2 = 0 THEN 'baseline' ELSE 'finetuned' END AS model_type,
         [1, 4, 8][event_id % 3 + 1]::INTEGER AS batch_size,
         [1, 3, 5][event_id % 3 + 1]::INTEGER AS beam_size,
         event_id % 2 = 0 AS glossary_enabled, user_id % 2 = 1 AS cache_enabled,
         round(value, 6) AS elapsed_time, (event_id % 50 + 1)::INTEGER AS num_sentences,
         CASE WHEN value > 0 THEN round((event_id % 50 + 1) / value, 4) ELSE 0.0 END AS sent_per_sec,
         (CASE WHEN user_id % 2 = 1 THEN event_id % 50 + 1 ELSE 0 END)::INTEGER AS cache_hits
  FROM events
)"""

ORACLES["throughput"] = _with(RUNS) + """
SELECT row_no, mode, model_type, elapsed_time, num_sentences, sent_per_sec FROM runs"""

BEST = """
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mode ORDER BY {m} DESC, row_no) AS rn FROM runs)
  WHERE rn = 1
)"""

ORACLES["best_run"] = _with(RUNS, BEST.format(m="sent_per_sec")) + """
SELECT mode, row_no, model_type, batch_size, beam_size, sent_per_sec FROM best"""

MODEL_CMP = """
mc AS (
  SELECT b.sent_per_sec AS baseline_sent_per_sec, f.sent_per_sec AS finetuned_sent_per_sec,
         CASE WHEN b.sent_per_sec = 0 THEN 0.0 ELSE (f.sent_per_sec - b.sent_per_sec) / b.sent_per_sec * 100.0 END AS speed_change_pct,
         b.elapsed_time AS baseline_elapsed_time, f.elapsed_time AS finetuned_elapsed_time,
         CASE WHEN b.elapsed_time = 0 THEN 0.0 ELSE (f.elapsed_time - b.elapsed_time) / b.elapsed_time * 100.0 END AS latency_change_pct
  FROM (SELECT * FROM runs WHERE mode = 'model_compare' AND model_type = 'baseline' ORDER BY row_no LIMIT 1) b,
       (SELECT * FROM runs WHERE mode = 'model_compare' AND model_type = 'finetuned' ORDER BY row_no LIMIT 1) f
)"""

CACHE_CMP = """
cc AS (
  SELECT o.sent_per_sec AS cache_off_sent_per_sec, n.sent_per_sec AS cache_on_sent_per_sec,
         CASE WHEN o.sent_per_sec = 0 THEN 0.0 ELSE (n.sent_per_sec - o.sent_per_sec) / o.sent_per_sec * 100.0 END AS cache_speedup_pct,
         o.elapsed_time AS cache_off_elapsed_time, n.elapsed_time AS cache_on_elapsed_time,
         CASE WHEN o.elapsed_time = 0 THEN 0.0 ELSE (o.elapsed_time - n.elapsed_time) / o.elapsed_time * 100.0 END AS cache_latency_reduction_pct,
         n.cache_hits::DOUBLE AS cache_hits
  FROM (SELECT * FROM runs WHERE mode = 'cache_compare' AND NOT cache_enabled ORDER BY row_no LIMIT 1) o,
       (SELECT * FROM runs WHERE mode = 'cache_compare' AND cache_enabled ORDER BY row_no LIMIT 1) n
)"""

ORACLES["model_compare"] = _with(RUNS, MODEL_CMP) + "\nSELECT * FROM mc"
ORACLES["cache_compare"] = _with(RUNS, CACHE_CMP) + "\nSELECT * FROM cc"

ORACLES["metrics_rows"] = _with(SYSTEMS, RUNS, MODEL_CMP, CACHE_CMP, f"""
sys_bleu AS (SELECT system, {_bleu_expr()} AS bleu FROM ({_stats_select('system')})),
bp AS (SELECT max(bleu) FILTER (WHERE system = 'baseline') AS baseline_bleu,
              max(bleu) FILTER (WHERE system = 'finetuned') AS finetuned_bleu FROM sys_bleu)""") + """
SELECT 'bleu' AS category, 'baseline_bleu' AS metric, round(baseline_bleu, 4) AS value, 'test set' AS notes FROM bp
UNION ALL SELECT 'bleu', 'finetuned_bleu', round(finetuned_bleu, 4), 'test set' FROM bp
UNION ALL SELECT 'bleu', 'bleu_improvement_pct',
  round(CASE WHEN baseline_bleu = 0 THEN 0.0 ELSE (finetuned_bleu - baseline_bleu) / baseline_bleu * 100.0 END, 2),
  '(finetuned-baseline)/baseline*100' FROM bp
UNION ALL SELECT 'throughput', 'model_compare_speed_change_pct', round(speed_change_pct, 2), 'finetuned vs baseline sent_per_sec' FROM mc
UNION ALL SELECT 'latency', 'model_compare_latency_change_pct', round(latency_change_pct, 2), 'finetuned vs baseline elapsed_time' FROM mc
UNION ALL SELECT 'cache', 'cache_speedup_pct', round(cache_speedup_pct, 2), 'cache_on vs cache_off sent_per_sec' FROM cc
UNION ALL SELECT 'cache', 'cache_latency_reduction_pct', round(cache_latency_reduction_pct, 2), '(off-on)/off*100' FROM cc
UNION ALL SELECT 'cache', 'cache_hits', round(cache_hits, 0), 'cache_compare, cache_enabled=True' FROM cc"""

ORACLES["run_series"] = _with(RUNS) + """
SELECT model_type, batch_size AS x, elapsed_time, row_no FROM runs WHERE mode = 'batch_compare'"""


def _best_label(mode: str, metric: str, key: str, label: str) -> str:
    return (f"SELECT '{label}' AS label, '{key}' AS key, CAST({key} AS VARCHAR) AS key_value, "
            f"{metric}::DOUBLE AS value FROM (SELECT * FROM runs WHERE mode = '{mode}' "
            f"ORDER BY {metric} DESC, row_no LIMIT 1)")


ORACLES["highlights"] = _with(RUNS, MODEL_CMP, CACHE_CMP) + "\n" + "\nUNION ALL ".join([
    _best_label("model_compare", "sent_per_sec", "model_type", "fastest_model"),
    _best_label("batch_compare", "sent_per_sec", "batch_size", "best_batch_throughput"),
    _best_label("beam_compare", "sent_per_sec", "beam_size", "fastest_beam"),
    _best_label("cache_compare", "cache_hits", "cache_enabled", "highest_cache_hits"),
    "SELECT 'throughput_change_pct', 'model_compare', 'finetuned_vs_baseline', speed_change_pct FROM mc",
    "SELECT 'cache_speedup_pct', 'cache_compare', 'on_vs_off', cache_speedup_pct FROM cc",
])

ORACLES["repeat_rows"] = _with(SENTENCES) + """
SELECT doc_id, pos, sentence, c::INTEGER AS copy FROM sentences, range(6) t(c)"""

# --- vocabulary --------------------------------------------------------------------


def _vocab(side: str) -> str:
    return ORACLE_PREP + f""",
lines AS (SELECT line_no, string_split({side}, ' ') AS l FROM split WHERE split = 'train' AND {side} <> ''),
occ AS (SELECT line_no, unnest(range(len(l))) AS p, unnest(l) AS token FROM lines),
occ2 AS (SELECT * FROM occ WHERE token NOT IN ('<blank>', '<s>', '</s>', '<unk>')),
firstl AS (SELECT token, count(*) AS cnt, min(line_no) AS fl FROM occ2 GROUP BY token),
firstp AS (SELECT o.token, min(o.p) AS fp FROM occ2 o JOIN firstl f ON f.token = o.token AND o.line_no = f.fl
           GROUP BY o.token)
SELECT token, cnt AS count, (row_number() OVER (ORDER BY cnt DESC, fl, fp) + 4)::BIGINT AS rank
FROM firstl JOIN firstp USING (token)
UNION ALL SELECT * FROM (VALUES ('<blank>', 1000000, 1), ('<s>', 1000000, 2), ('</s>', 1000000, 3),
                                ('<unk>', 1000000, 4)) v(token, count, rank)"""


ORACLES["vocab_src"] = _vocab("source")
ORACLES["vocab_tgt"] = _vocab("target")

ORACLES["pairs_csv_roundtrip"] = _with(RAW_PAIRS, CLEANED) + """
SELECT source, target FROM cleaned WHERE valid GROUP BY source, target"""

ORACLES["compare_beams"] = _with(RUNS) + """
SELECT a.sent_per_sec AS a_sent_per_sec, b.sent_per_sec AS b_sent_per_sec,
       CASE WHEN a.sent_per_sec = 0 THEN 0.0 ELSE (b.sent_per_sec - a.sent_per_sec) / a.sent_per_sec * 100.0 END
         AS sent_per_sec_change_pct,
       a.elapsed_time AS a_elapsed_time, b.elapsed_time AS b_elapsed_time,
       CASE WHEN a.elapsed_time = 0 THEN 0.0 ELSE (b.elapsed_time - a.elapsed_time) / a.elapsed_time * 100.0 END
         AS elapsed_time_change_pct
FROM (SELECT * FROM runs WHERE mode = 'beam_compare' AND beam_size = 1 ORDER BY row_no LIMIT 1) a,
     (SELECT * FROM runs WHERE mode = 'beam_compare' AND beam_size = 5 ORDER BY row_no LIMIT 1) b"""

ORACLES["fan_out"] = _with(SENTENCES, MEMORY, PENDING) + f"""
SELECT s.doc_id, s.pos, s.sentence, p.translation
FROM sentences s LEFT JOIN (SELECT sentence, {_reverse('sentence')} AS translation FROM pending) p
  ON p.sentence = s.sentence"""

ORACLES["corpus_audit"] = _with(RAW_PAIRS, CLEANED) + f"""
SELECT coalesce(sum(n), 0)::BIGINT AS input_rows,
       (count(*) FILTER (WHERE valid))::BIGINT AS output_rows,
       coalesce(sum(n_modified), 0)::BIGINT AS modified_rows,
       coalesce(sum(n) FILTER (WHERE NOT valid), 0)::BIGINT AS dropped_invalid,
       coalesce(sum(n - 1) FILTER (WHERE valid), 0)::BIGINT AS dropped_dup,
       (count(*) FILTER (WHERE valid AND nonempty))::BIGINT AS loaded,
       (count(*) FILTER (WHERE valid AND nonempty AND NOT keep))::BIGINT AS dropped_by_filter
FROM (SELECT source, target, count(*) AS n, count(*) FILTER (WHERE modified) AS n_modified,
             bool_or(valid) AS valid,
             bool_or({_norm('source')} <> '' AND {_norm('target')} <> '') AS nonempty,
             bool_or({_norm('source')} <> '' AND {_norm('target')} <> ''
                     AND {_keep(_norm('source'), _norm('target'))}) AS keep
      FROM cleaned GROUP BY source, target)"""

ORACLES["corpus_audited_split"] = ORACLE_PREP + """
SELECT * FROM split"""

ORACLES["stream_clean"] = _with(RAW_PAIRS, CLEANED) + f"""
SELECT line_no, {_norm('source')} AS source, {_norm('target')} AS target
FROM cleaned
WHERE valid AND {_norm('source')} <> '' AND {_norm('target')} <> ''
  AND {_keep(_norm('source'), _norm('target'))}"""

# --- files and snapshots read back ---------------------------------------------------

ORACLES["bitext_roundtrip"] = ORACLE_PREP + """
SELECT (row_number() OVER (ORDER BY split_key) - 1)::BIGINT AS line_no, source, target FROM split WHERE split = 'train'"""

ORACLES["splits_roundtrip"] = ORACLE_PREP + "\nSELECT line_no, source, target, split_key, split FROM split"

ORACLES["documents_from_files"] = "SELECT item_id::VARCHAR AS item_id, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS text FROM benchmark"

BENCH_WORDS = """
bench_words AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-zà-öø-ÿ]{2,}')) AS word FROM benchmark)"""

ORACLES["glossary_roundtrip"] = _with(BENCH_WORDS) + """
SELECT (row_number() OVER (ORDER BY encode(word)) - 1)::BIGINT AS ord, word AS source_term,
       CASE WHEN length(word) % 2 = 0 THEN '2 ' ELSE '' END || reverse(word) AS target_term
FROM bench_words"""

# A term changes a sentence if the sentence holds it, or if it is a part of a placeholder.
ORACLES["glossary_large"] = _with(SENTENCES, BENCH_WORDS) + """,
terms AS (
  SELECT word, '__TERM_' || (row_number() OVER (ORDER BY length(word) DESC, unicode(word), encode(word)) - 1) || '__' AS mark,
         row_number() OVER (ORDER BY length(word) DESC, unicode(word), encode(word)) AS place
  FROM bench_words
),
texts AS (SELECT DISTINCT sentence, lower(sentence) AS folded FROM sentences),
found AS (SELECT sentence, word, mark, place FROM texts JOIN terms ON contains(folded, word)),
touching AS (
  SELECT sentence, word, mark, place FROM (SELECT DISTINCT sentence FROM found), terms WHERE contains('term', word)
),
lists AS (
  SELECT sentence, list({'t': '', 'm': '', 'p': word, 'h': mark, 'g': reverse(word)} ORDER BY place) AS l
  FROM (SELECT * FROM found UNION SELECT * FROM touching) GROUP BY sentence
),
done AS (
  SELECT sentence, list_reduce(list_concat([{'t': sentence, 'm': '', 'p': '', 'h': '', 'g': ''}], l),
    lambda a, x: {'t': regexp_replace(a.t, x.p, x.h, 'gi'),
                  'm': CASE WHEN regexp_matches(a.t, x.p, 'i')
                            THEN a.m || CASE WHEN a.m = '' THEN '' ELSE '|' END || x.h || '=' || x.g ELSE a.m END,
                  'p': x.p, 'h': x.h, 'g': x.g}) AS r
  FROM lists
),
back AS (
  SELECT sentence, r.t AS protected, r.m AS terms,
         list_reduce(list_concat([r.t], string_split(r.m, '|')),
                     lambda a, x: CASE WHEN x = '' THEN a
                                       ELSE replace(a, split_part(x, '=', 1), split_part(x, '=', 2)) END) AS restored
  FROM done
)
SELECT doc_id, pos, coalesce(protected, s.sentence) AS protected, coalesce(terms, '') AS terms,
       coalesce(restored, s.sentence) AS restored
FROM sentences s LEFT JOIN back USING (sentence)"""

ORACLES["memory_snapshots"] = _with(SENTENCES, MEMORY) + """
SELECT source, CASE WHEN length(source) % 2 = 0 THEN '[new] ' || source ELSE translation END AS translation FROM memory"""

ORACLES["memory_json"] = _with(SENTENCES, MEMORY) + "\nSELECT source, translation FROM memory"

ORACLES["runs_roundtrip"] = _with(RUNS) + """
SELECT mode, model_type, batch_size, beam_size, glossary_enabled, cache_enabled, elapsed_time, num_sentences,
       sent_per_sec, cache_hits, (row_number() OVER (ORDER BY row_no) - 1)::BIGINT AS row_no FROM runs"""

ORACLES["vocab_file"] = ORACLES["vocab_tgt"]

ORACLES["translations_text"] = _with(SENTENCES) + f"""
SELECT doc_id, pos, {_reverse('sentence')} AS translation FROM sentences WHERE doc_id % 10 <> 3"""

ORACLES["translated_texts"] = _with(SENTENCES) + f"""
SELECT d.doc_id, coalesce(t.translation, '') AS translation
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg({_reverse('sentence')}, chr(10) ORDER BY pos) AS translation
  FROM sentences WHERE doc_id % 10 <> 3 GROUP BY doc_id) t USING (doc_id)"""

# --- text functions ---------------------------------------------------------------------


def _markers(x: str) -> str:
    return "(" + " + ".join(f"contains({x}, '{m}')::INTEGER" for m in "ÃÂâðï") + ")"


def _cleaned_side(x: str) -> str:
    blanks = f"replace(replace({x}, chr(160), ' '), chr(133), ' ')"
    return (f"replace(trim(regexp_replace(regexp_replace({blanks}, '[\\x00-\\x08\\x0A-\\x1F]', '', 'g'), "
            f"'\\s+', ' ', 'g')), '_', '')")


# UTF-8 bytes of every character, each read as one Latin-1 character.
_AS_LATIN1 = """array_to_string(list_transform(string_split(sentence, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN c
         WHEN unicode(c) < 2048 THEN chr(192 + unicode(c) // 64) || chr(128 + unicode(c) % 64)
         WHEN unicode(c) < 65536 THEN chr(224 + unicode(c) // 4096) || chr(128 + unicode(c) // 64 % 64) || chr(128 + unicode(c) % 64)
         ELSE chr(240 + unicode(c) // 262144) || chr(128 + unicode(c) // 4096 % 64) || chr(128 + unicode(c) // 64 % 64)
              || chr(128 + unicode(c) % 64) END), '')"""

ORACLES["mojibake_repair"] = _with(SENTENCES) + f""",
garbled AS (
  SELECT doc_id, pos, sentence,
         CASE WHEN doc_id % 3 = 0 THEN {_AS_LATIN1}
              WHEN doc_id % 3 = 1 AND regexp_full_match(sentence, '[\x00-\x7f{GBK_READ[0]}]*')
              THEN translate(sentence, '{GBK_READ[0]}', '{GBK_READ[1]}') ELSE sentence END AS raw
  FROM sentences
)
SELECT doc_id, pos, raw,
       CASE WHEN doc_id % 3 = 0 AND NOT {_markers('sentence')} < {_markers('raw')}
            THEN {_cleaned_side('raw')} ELSE {_cleaned_side('sentence')} END AS repaired
FROM garbled"""

ORACLES["safe_float_text"] = _with(SENTENCES) + """
SELECT doc_id, pos, coalesce(TRY_CAST(sentence AS DOUBLE),
  TRY_CAST(nullif(regexp_extract(sentence, '[-+]?\\d*\\.?\\d+'), '') AS DOUBLE), 0.0) AS number FROM sentences"""

ORACLES["report_text"] = f"""
SELECT category, metric, CASE WHEN metric IN ('baseline_bleu', 'finetuned_bleu') THEN printf('%.4f', value)
                              WHEN metric = 'cache_hits' THEN printf('%.0f', value) ELSE printf('%.2f', value) END AS text
FROM ({ORACLES["metrics_rows"]})"""

ORACLES["concat_runs"] = _with(RUNS) + """
SELECT row_no, mode, batch_size, elapsed_time FROM runs WHERE mode IN ('batch_compare', 'beam_compare', 'cache_compare')"""

ORACLES["pair_checks"] = _with(RAW_PAIRS, LOADED) + f"""
SELECT lang, count(*)::BIGINT AS pairs, count(*) >= 500 AS enough
FROM loaded JOIN (SELECT doc_id, lang FROM documents) ON doc_id = line_no // {LINE_STRIDE}
WHERE {_keep('source', 'target')} GROUP BY lang"""

# Line keys are compared as text.
for _name in ("pairs_clean", "keep_pairs", "token_counts", "split_exact", "split_hash", "prepare_corpus",
              "conversation_corpus", "corpus_audited_split", "align_lines", "stream_clean", "splits_roundtrip"):
    ORACLES[_name] = f"SELECT * REPLACE (line_no::VARCHAR AS line_no) FROM ({ORACLES[_name]})"
