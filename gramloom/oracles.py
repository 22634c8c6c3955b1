r"""Independent SQL for the registered queries, run by DuckDB on the same tables.

The statements share common table expressions, put together here by name.
"""

from __future__ import annotations

from gramloom.functions.tokens import ALNUM_OR_PUNCT, WORD
from gramloom.queries import CHAIN_LENGTH, RANDOM_SEED

WORDS = "regexp_extract_all(replace(lower({0}), '’', ''''), '" + WORD.replace("'", "''").replace("{", "{{").replace("}", "}}") + "')"


def _sentences(name: str, table: str, keys: str) -> str:
    words = WORDS.format("parts[i]")
    return f"""{name} AS MATERIALIZED (
  SELECT {keys}, i - 1 AS sent_no, list_concat(['<s>'], ws, ['</s>']) AS toks
  FROM (SELECT {keys}, i, {words} AS ws
        FROM (SELECT {keys}, string_split_regex(replace(text, '<unk>', ' '), '[.!?]+') AS parts FROM {table}) x,
             unnest(range(1, len(parts) + 1)) AS u(i)) y
  WHERE len(ws) > 0)"""


def _grams(name: str, source: str, orders: list[int]) -> str:
    values = ", ".join(f"({k})" for k in orders)
    return f"""{name} AS MATERIALIZED (
  SELECT o::TINYINT AS ord, array_to_string(toks[i:i + o - 1], ' ') AS state_key, toks[i + o] AS next_token,
         count(*) AS count
  FROM {source}, (VALUES {values}) AS v(o), unnest(range(1, len(toks) - o + 1)) AS u(i)
  GROUP BY ALL)"""


DOCS = _sentences("docs", "documents", "doc_id, source")
MSGS = _sentences("msgs", "conversations", "conv_id, turn, role")
TRANS = _grams("trans", "docs", [1, 2, 3])
STATES = """states AS MATERIALIZED (
  SELECT ord, state_key, sum(count)::BIGINT AS total, count(*) AS n_candidates FROM trans GROUP BY ALL)"""
VOCAB = "vocab AS MATERIALIZED (SELECT token, count(*) AS freq FROM (SELECT unnest(toks) AS token FROM docs) t GROUP BY token)"
VOCAB_IDS = """ids AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY substr(md5(token), 1, 3), token) AS id, token, freq FROM vocab)"""
REAL = "token <> '<s>' AND token <> '</s>'"
BY_TOKEN = "substr(md5(next_token), 1, 3), next_token"
RANGES = f"""ranges AS MATERIALIZED (
  SELECT ord, state_key, next_token, count,
         (sum(count) OVER w - count)::BIGINT AS lo, (sum(count) OVER w)::BIGINT AS hi,
         (sum(count) OVER (PARTITION BY ord, state_key))::BIGINT AS total,
         count(*) OVER (PARTITION BY ord, state_key) AS n_candidates
  FROM trans WINDOW w AS (PARTITION BY ord, state_key ORDER BY {BY_TOKEN} ROWS UNBOUNDED PRECEDING))"""
GROWN = [
    DOCS, MSGS, _grams("a", "docs", [1, 2]), _grams("b", "msgs", [1]),
    """grown AS MATERIALIZED (
  SELECT ord, state_key, next_token, sum(count)::BIGINT AS count
  FROM (SELECT * FROM a UNION ALL SELECT * FROM b) u GROUP BY ALL)""",
    """sources AS MATERIALIZED (
  SELECT 1 AS batch, source AS name, sum(len(toks))::BIGINT AS token_count, sum(len(toks) - 1)::BIGINT AS n1,
         sum(len(toks) - 2)::BIGINT AS n2 FROM docs GROUP BY source
  UNION ALL
  SELECT 2, role, sum(len(toks))::BIGINT, sum(len(toks) - 1)::BIGINT, NULL FROM msgs GROUP BY role)""",
    """ledger AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY batch, substr(md5(name), 1, 3), name) AS id, * FROM sources)""",
]
HISTORY = "prompts AS MATERIALIZED (SELECT run_id, requested_order, max_tokens, CASE WHEN len(w) = 0 THEN ['<s>'] ELSE w END AS hist\n" \
          "  FROM (SELECT conv_id * 1000 + turn AS run_id, turn % 3 + 1 AS requested_order, turn % 3 + 2 AS max_tokens,\n" \
          f"               {WORDS.format('text')} AS w FROM conversations) p)"


def _unit(*parts: str) -> str:
    joined = " || ':' || ".join(f"({p})::VARCHAR" for p in parts)
    return f"(('0x' || substr(md5({joined}), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def _walk(start: str, steps: int, sentences: bool, exact_order: int | None = None) -> list[str]:
    """One pair of table expressions per step: the state that fires, and the candidate drawn."""
    ctes, previous = [], start
    for s in range(steps):
        order = f"o = {exact_order}" if exact_order else "o <= requested_order"
        ctes.append(f"""fired{s} AS MATERIALIZED (
  SELECT k.run_id, max(st.ord) AS ord, arg_max(st.state_key, st.ord) AS state_key, arg_max(st.total, st.ord) AS total,
         floor({_unit(str(RANDOM_SEED), 'k.run_id', str(s))} * arg_max(st.total, st.ord))::BIGINT AS draw
  FROM (SELECT run_id, o::TINYINT AS o, array_to_string(hist[-o:], ' ') AS key
        FROM {previous}, (VALUES (1), (2), (3)) AS v(o)
        WHERE max_tokens > {s} AND {order} AND o <= len(hist)) k
  JOIN states st ON st.ord = k.o AND st.state_key = k.key
  GROUP BY k.run_id)""")
        new = "CASE WHEN r.next_token = '</s>' THEN ['</s>', '<s>'] ELSE [r.next_token] END" if sentences else "[r.next_token]"
        ctes.append(f"""step{s} AS MATERIALIZED (
  SELECT f.run_id, {s}::INTEGER AS step, f.state_key, f.ord AS order_used, r.next_token,
         r.count::DOUBLE / r.total AS chosen_prob, r.n_candidates,
         p.requested_order, p.max_tokens, list_concat(p.hist, {new}) AS hist
  FROM fired{s} f JOIN {previous} p ON p.run_id = f.run_id
  JOIN ranges r ON r.ord = f.ord AND r.state_key = f.state_key
  WHERE f.draw >= r.lo AND f.draw < r.hi)""")
        previous = f"step{s}"
    columns = "run_id, step, state_key, order_used, next_token, chosen_prob, n_candidates"
    union = " UNION ALL ".join(f"SELECT {columns} FROM step{s}" for s in range(steps))
    return ctes + [f"steps AS MATERIALIZED ({union})"]


WALK = [DOCS, TRANS, STATES, RANGES, HISTORY, *_walk("prompts", 4, True)]
TEXTS = """texts AS MATERIALIZED (
  SELECT run_id,
         replace(regexp_replace(array_to_string(list_concat(words, grown), ' '), '^(</s>( |$))+', ''), ' </s>', '.') AS text,
         tokens, CASE WHEN made < max_tokens THEN 'dead end' ELSE 'token limit' END AS stop_reason
  FROM (SELECT p.run_id, p.max_tokens, CASE WHEN p.hist = ['<s>'] THEN [] ELSE p.hist END AS words,
               coalesce(list(s.next_token ORDER BY s.step) FILTER (s.step IS NOT NULL), []) AS grown,
               count(s.step) AS made, count(*) FILTER (s.next_token <> '</s>') AS tokens
        FROM prompts p LEFT JOIN steps s ON s.run_id = p.run_id GROUP BY ALL) t)"""
FORCED = """forced AS MATERIALIZED (
  SELECT g.conv_id, g.turn, g.sent_no, g.pos, f.ord AS order_used, f.state_key, g.next_token,
         t.count::DOUBLE / f.total AS chosen_prob, f.n_candidates
  FROM (SELECT conv_id, turn, sent_no, p AS pos, toks[p] AS next_token
        FROM msgs, unnest(range(2, len(toks) + 1)) AS u(p)) g
  LEFT JOIN (SELECT conv_id, turn, sent_no, pos, max(ord) AS ord, arg_max(state_key, ord) AS state_key,
                    arg_max(total, ord) AS total, arg_max(n_candidates, ord) AS n_candidates
             FROM (SELECT m.conv_id, m.turn, m.sent_no, p AS pos, st.*
                   FROM (SELECT conv_id, turn, sent_no, p, o, array_to_string(toks[p - o:p - 1], ' ') AS key
                         FROM msgs, (VALUES (1), (2), (3)) AS v(o), unnest(range(2, len(toks) + 1)) AS u(p)
                         WHERE p > o) m
                   JOIN states st ON st.ord = m.o AND st.state_key = m.key) k
             GROUP BY ALL) f
    ON f.conv_id = g.conv_id AND f.turn = g.turn AND f.sent_no = g.sent_no AND f.pos = g.pos
  LEFT JOIN trans t ON t.ord = f.ord AND t.state_key = f.state_key AND t.next_token = g.next_token)"""
LETTERS = r"""lettered AS (
  SELECT doc_id, CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END AS toks
  FROM (SELECT doc_id, string_split_regex(regexp_replace(text, '[^A-Za-z \t]', '', 'g'), '[ \t]') AS p FROM documents) x)"""
CHAIN = [
    LETTERS, _grams("trans", "lettered", [1]), STATES, RANGES,
    f"""begun AS MATERIALIZED (
  SELECT b.run_id, 1 AS requested_order, {CHAIN_LENGTH - 1} AS max_tokens, [s.state_key] AS hist
  FROM (SELECT item_id AS run_id,
               floor({_unit(str(RANDOM_SEED), 'item_id', "'start'")} * (SELECT count(*) FROM states))::BIGINT + 1 AS pick
        FROM benchmark) b
  JOIN (SELECT state_key, row_number() OVER (ORDER BY substr(md5(state_key), 1, 3), state_key) AS id FROM states) s
    ON s.id = b.pick)""",
    *_walk("begun", CHAIN_LENGTH - 1, False, 1),
    """chained AS (
  SELECT b.run_id, array_to_string(list_concat(b.hist, coalesce(list(s.next_token ORDER BY s.step)
           FILTER (s.step IS NOT NULL), [])), ' ') AS chain
  FROM begun b LEFT JOIN steps s ON s.run_id = b.run_id GROUP BY b.run_id, b.hist)""",
]
# Each from its definition: totals and parts counted apart; a run's probability as one sum of logarithms; the
# entropy of the uncounted next tokens of a state; a rank as one more than the number of more frequent words.
BACKOFF = """SELECT fired.order_used, fired.steps, round(100.0::DOUBLE * fired.steps / everything.steps, 1) AS pct
FROM (SELECT order_used, count(*) AS steps FROM {0} WHERE order_used > 0 GROUP BY order_used) fired,
     (SELECT count(*) AS steps FROM {0} WHERE order_used > 0) everything
UNION ALL
SELECT NULL, count(*), 100.0::DOUBLE FROM {0} WHERE order_used > 0 HAVING count(*) > 0"""
PERPLEXITY = """SELECT {1}, tokens, round(bits, 3) AS avg_surprise_bits, round(exp(bits * ln(2.0::DOUBLE)), 2) AS perplexity
FROM (SELECT {1}, count(*) AS tokens, -sum(ln(chosen_prob)) / ln(2.0::DOUBLE) / count(*) AS bits
      FROM {0} WHERE chosen_prob > 0 GROUP BY {1}) scored"""
ENTROPY = """SELECT o::TINYINT AS ord, array_to_string(toks[i:i + o - 1], ' ') AS state_key,
       count(DISTINCT toks[i + o]) AS branches, round(entropy(toks[i + o]), 3) AS entropy_bits
FROM docs, (VALUES (1), (2), (3)) AS v(o), unnest(range(1, len(toks) - o + 1)) AS u(i)
GROUP BY ALL HAVING count(DISTINCT toks[i + o]) > 1"""
RANKED = f"""sized AS MATERIALIZED (SELECT freq, count(*) AS m FROM vocab WHERE {REAL} GROUP BY freq),
ranked AS MATERIALIZED (
  SELECT token, vocab.freq, more + 1 AS rank
  FROM vocab JOIN (SELECT a.freq, coalesce(sum(b.m), 0)::BIGINT AS more
                   FROM sized a LEFT JOIN sized b ON b.freq > a.freq GROUP BY a.freq) r
    ON r.freq = vocab.freq WHERE {REAL})"""
SUMMARY = "SELECT ord, count(*) AS transitions, count(DISTINCT state_key) AS states FROM grown {0} GROUP BY ord"
CHECKS = [
    "vocabulary.id unique", "vocabulary.token unique", "vocabulary not null", "documents.id unique",
    "documents not null", "training_runs.id unique", "training_runs not null", "transitions key unique",
    "transitions not null", "training_runs.document_id known", "transitions.next_token known",
    "generation_runs.run_id unique", "generation_steps key unique", "generation_steps.run_id known",
    "generation_steps.chosen_next_id known",
]
# Walks recorded twice: ids in the order of (md5 bucket, run), then on from there.
LOG = """numbered AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY substr(md5(run_id::VARCHAR), 1, 3), run_id) AS id, run_id, requested_order, max_tokens FROM prompts),
log AS MATERIALIZED (
  SELECT id + again * (SELECT count(*) FROM prompts) AS id, run_id, requested_order, max_tokens FROM numbered, (VALUES (0), (1)) AS v(again))"""
LOGGED = "logged AS MATERIALIZED (SELECT l.id, s.* FROM log l JOIN steps s ON s.run_id = l.run_id)"
STEP_COLUMNS = "run_id, step, state_key, order_used, next_token, chosen_prob, n_candidates"


def _with(ctes: list[str], select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def oracle_sql() -> dict[str, str]:
    model = [DOCS, TRANS]
    return {
        "transitions_o1_o3": _with(model, "SELECT * FROM trans"),
        "sentence_tokens": _with([DOCS], "SELECT doc_id, sent_no, len(toks) AS n_tokens, array_to_string(toks, ' ') AS sentence FROM docs"),
        "doc_tokens": _with([DOCS], "SELECT doc_id, sent_no, p AS pos, toks[p] AS token FROM docs, unnest(range(1, len(toks) + 1)) AS u(p)"),
        "doc_token_counts": _with([DOCS], "SELECT doc_id, count(*) AS sentences, sum(len(toks))::BIGINT AS token_count FROM docs GROUP BY doc_id"),
        "vocab_freq": _with([DOCS, VOCAB], "SELECT * FROM vocab"),
        "tokenize_letters": _with([LETTERS], "SELECT doc_id, len(toks) AS n_tokens, array_to_string(toks, '|') AS tokens FROM lettered"),
        "tokenize_punct": f"""SELECT doc_id, len(t) AS n_tokens, array_to_string(t, '|') AS tokens
FROM (SELECT doc_id, regexp_extract_all(text, '{ALNUM_OR_PUNCT}') AS t FROM documents) x""",
        "ngrams_window": _with(model, "SELECT * FROM trans WHERE ord = 2"),
        "ngrams_added": _with([DOCS], """SELECT source, o::TINYINT AS ord, sum(greatest(len(toks) - o, 0))::BIGINT AS ngrams_added
FROM docs, (VALUES (1), (2), (3)) AS v(o) GROUP BY ALL"""),
        "ngrams_unsegmented": _with([LETTERS, _grams("g", "lettered", [2])], "SELECT * FROM g"),
        "prompt_tokens": f"""SELECT conv_id, turn, CASE WHEN len(w) = 0 THEN '<s>' ELSE array_to_string(w, ' ') END AS history
FROM (SELECT conv_id, turn, {WORDS.format('text')} AS w FROM conversations) p""",
        "source_sizes": "SELECT source, format_bytes(sum(n_chars)::BIGINT) AS size_text FROM documents GROUP BY source",
        "model_vocabulary": _with([DOCS, VOCAB, VOCAB_IDS], "SELECT id, token, freq FROM ids"),
        "transitions_ids": _with([*model, VOCAB, VOCAB_IDS], """SELECT ord, state_key, id AS next_id, count
FROM trans JOIN ids ON token = next_token WHERE ord <= 2"""),
        "zipf": _with([DOCS, VOCAB, RANKED], "SELECT token, freq, rank FROM ranked ORDER BY freq DESC, token LIMIT 30"),
        "vocab_rank": _with([DOCS, VOCAB, RANKED], "SELECT token, freq, rank FROM ranked"),
        "state_totals": _with([*model, STATES], "SELECT * FROM states"),
        "successor_lists": _with([*model, """placed AS (SELECT ord, state_key, next_token, count,
  row_number() OVER (PARTITION BY ord, state_key ORDER BY next_token) - 1 AS pos FROM trans)"""],
                                 """SELECT ord, state_key, pos // 1000 AS part, count(*) AS entries, sum(count)::BIGINT AS total,
       string_agg(next_token || ':' || count, ' ' ORDER BY next_token) AS successors
FROM placed GROUP BY ord, state_key, pos // 1000"""),
        "next_distribution": _with(model, """SELECT ord, state_key, next_token, count,
       count::DOUBLE / sum(count) OVER s AS prob, count(*) OVER s AS n_candidates
FROM trans WINDOW s AS (PARTITION BY ord, state_key)"""),
        "entropy": _with([DOCS], ENTROPY + " ORDER BY entropy_bits DESC, ord, state_key LIMIT 20"),
        "entropy_all_states": _with([DOCS], ENTROPY),
        "model_summary": _with(model, """SELECT count(*) AS transitions, count(DISTINCT (ord, state_key)) AS states
FROM trans WHERE ord <= 2"""),
        "size": _with(GROWN, """SELECT g.ord, count(*) AS transitions, count(DISTINCT g.state_key) AS states,
       format_bytes(sum(length(g.state_key) + 13)::BIGINT) AS model_size,
       any_value(CASE WHEN g.ord = 1 THEN l.every ELSE l.deep END) AS trained_on
FROM grown g, (SELECT string_agg(name, ', ' ORDER BY name) AS every,
                      string_agg(name, ', ' ORDER BY name) FILTER (batch = 1) AS deep FROM ledger) l
GROUP BY g.ord"""),
        "size_estimate": _with(GROWN, "SELECT ord, true AS transitions_within, true AS states_within FROM grown GROUP BY ord"),
        "growth": _with(GROWN, """SELECT row_number() OVER o AS run, name, ord, ngrams_added,
       (sum(ngrams_added) OVER o)::BIGINT AS cumulative_ngrams
FROM (SELECT id, name, 1::TINYINT AS ord, n1 AS ngrams_added FROM ledger
      UNION ALL SELECT id, name, 2::TINYINT, n2 FROM ledger WHERE batch = 1) r
WINDOW o AS (ORDER BY id, ord)"""),
        "trained_sources": _with(GROWN, """SELECT 1::TINYINT AS ord, name, count(*) AS times FROM ledger GROUP BY name
UNION ALL SELECT 2::TINYINT, name, count(*) FROM ledger WHERE batch = 1 GROUP BY name"""),
        "incremental_merge": _with(GROWN, "SELECT * FROM grown"),
        "train_guard": _with(GROWN, "SELECT id, name, token_count FROM ledger"),
        "vocab_ids": _with([*GROWN, """words AS (
  SELECT token, count(*) AS freq, min(batch) AS batch
  FROM (SELECT 1 AS batch, unnest(toks) AS token FROM docs UNION ALL SELECT 2, unnest(toks) FROM msgs) t GROUP BY token)"""],
            "SELECT row_number() OVER (ORDER BY batch, substr(md5(token), 1, 3), token) AS id, token, freq FROM words"),
        "forced_retrain": _with([MSGS, _grams("g", "msgs", [1, 2])], "SELECT ord, state_key, next_token, 2 * count AS count FROM g"),
        "prune_report": _with(GROWN, SUMMARY.format("WHERE count >= 2")),
        "compact_report": _with(GROWN, SUMMARY.format("")),
        "integrity": 'SELECT * FROM (VALUES ' + ", ".join(f"('{c}', 0::BIGINT)" for c in CHECKS) + ') AS v("check", violations)',
        "integrity_faults": _with(WALK, "SELECT * FROM (VALUES " + ", ".join(
            f"('{c}', 0::BIGINT)" for c in CHECKS if not c.startswith("generation")) + """) AS v("check", violations)
UNION ALL SELECT 'generation_runs.run_id unique', count(*) FROM prompts WHERE run_id % 7 = 0
UNION ALL SELECT 'generation_steps key unique', count(*) FROM steps WHERE run_id % 3 = 0
UNION ALL SELECT 'generation_steps.run_id known', count(DISTINCT run_id) FROM steps WHERE run_id % 5 = 0
UNION ALL SELECT 'generation_steps.chosen_next_id known', count(DISTINCT next_token) FROM steps WHERE step = 1"""),
        "backoff_lookup": _with([*model, STATES, HISTORY], """SELECT p.run_id, max(st.ord) AS order_used,
       arg_max(st.state_key, st.ord) AS state_key, arg_max(st.total, st.ord) AS total,
       arg_max(st.n_candidates, st.ord) AS n_candidates
FROM (SELECT run_id, o::TINYINT AS o, array_to_string(hist[-o:], ' ') AS key
      FROM prompts, (VALUES (1), (2), (3)) AS v(o) WHERE o <= len(hist)) p
JOIN states st ON st.ord = p.o AND st.state_key = p.key GROUP BY p.run_id"""),
        "draw_ranges": _with([*model, RANGES], "SELECT * FROM ranges"),
        "forced_steps": _with([*model, STATES, MSGS, FORCED], "SELECT * FROM forced"),
        "backoff_stats": _with([*model, STATES, MSGS, FORCED], BACKOFF.format("forced")),
        "perplexity": _with([*model, STATES, MSGS, FORCED], PERPLEXITY.format("forced", "conv_id")),
        "generation_runs": """SELECT conv_id * 1000 + turn AS run_id, text AS seed, (turn % 3 + 1)::TINYINT AS requested_order,
       (turn % 3 + 2)::INTEGER AS max_tokens FROM conversations""",
        "weighted_draw": _with(WALK, f"SELECT {STEP_COLUMNS} FROM step0"),
        "batch_walk": _with(WALK, "SELECT * FROM steps"),
        "generation_steps": _with([*WALK, VOCAB, VOCAB_IDS], """SELECT run_id, step, state_key, order_used, id AS chosen_next_id,
       chosen_prob, n_candidates FROM steps JOIN ids ON token = next_token"""),
        "detokenize": _with([*WALK, TEXTS], "SELECT * FROM texts"),
        "run_text_files": _with([*WALK, TEXTS], "SELECT run_id, tokens, text, tokens > 2 AS long_run FROM texts"),
        "generation_log": _with([*WALK, LOG], """SELECT l.id, c.text AS seed, l.requested_order::TINYINT AS requested_order,
       l.max_tokens::INTEGER AS max_tokens, count(s.step) AS steps, max(s.order_used) AS order_used
FROM log l JOIN conversations c ON c.conv_id * 1000 + c.turn = l.run_id LEFT JOIN steps s ON s.run_id = l.run_id GROUP BY ALL"""),
        "walk_backoff": _with([*WALK, LOG, LOGGED], BACKOFF.format("logged")),
        "walk_perplexity": _with([*WALK, LOG, LOGGED], PERPLEXITY.format("logged", "id")),
        "chains_random_start": _with(CHAIN, "SELECT run_id, chain FROM chained"),
        "chain_lines": _with(CHAIN, "SELECT chain FROM chained"),
        "read_csv_text": _with([MSGS], "SELECT role AS source_id, count(*) AS sentences, sum(len(toks))::BIGINT AS token_count FROM msgs GROUP BY role"),
        "read_text_files": _with([DOCS, VOCAB], "SELECT * FROM vocab"),
        "stream_split_source": _with([MSGS, _grams("g", "msgs", [1, 2])], "SELECT * FROM g"),
        "stream_incremental": _with([DOCS, MSGS, """both_tables AS (SELECT toks FROM docs UNION ALL SELECT toks FROM msgs)""",
                                     _grams("g", "both_tables", [1])], "SELECT * FROM g"),
    }
