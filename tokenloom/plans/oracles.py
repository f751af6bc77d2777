"""The catalogue's queries as SQL over the same tables, for an independent engine to check."""

from __future__ import annotations

from tokenloom.operators.subwords import Merges, vocabulary
from tokenloom.plans.catalogue import DIMS, FIXED_MERGES, SUBWORD_PARAMS, TOP_K, WIDE_MERGES, WINDOW

#: Length of the vectors of the table `embeddings`, which SQL has to know.
VECTOR_SIZE = 64
_SPACE = r"\t\n\x0B\f\r "
_STRIPPED = rf"regexp_replace(lower(text), '[^a-z0-9{_SPACE}]', '', 'g')"


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + select


# Words of each document in order.
_WORD_LISTS = rf"""lists AS (
  SELECT doc_id, list_filter(regexp_split_to_array({_STRIPPED}, '[{_SPACE}]+'), lambda x: x <> '') AS ws FROM documents)"""
_WORDS = """words AS (
  SELECT doc_id, unnest(ws) AS word, (generate_subscripts(ws, 1) - 1)::int AS pos FROM lists)"""
_FREQUENCY = "freq AS (SELECT word, count(*)::bigint AS frequency FROM words GROUP BY word)"
_VOCAB = "vocab AS (SELECT word, frequency, row_number() OVER (ORDER BY word) - 1 AS idx FROM freq)"
_WORD_PARTS = (_WORD_LISTS, _WORDS)
_VOCAB_PARTS = (_WORD_LISTS, _WORDS, _FREQUENCY, _VOCAB)


def _leads(token: str, seq: str | None, order: str) -> str:
    over = f"OVER ({f'PARTITION BY {seq} ' if seq else ''}ORDER BY {order})"
    ahead = ", ".join(f"lead({token}, {i}) {over} AS t{i}" for i in range(1, WINDOW + 1))
    last = f"row_number() {over} AS rn, count(*) OVER ({f'PARTITION BY {seq}' if seq else ''}) AS n"
    return f"{token} AS t0, {ahead}, {last}"


_CORPUS_WINDOWS = f"""win AS (SELECT * FROM (SELECT doc_id, pos::bigint AS pos, {_leads('word', 'doc_id', 'pos')} FROM words)
  WHERE t{WINDOW} IS NOT NULL)"""
_LISTING_WINDOWS = f"""win AS (SELECT * FROM (SELECT idx AS pos, {_leads('idx', None, 'idx')} FROM vocab)
  WHERE t{WINDOW} IS NOT NULL)"""
_LISTING_WORD_WINDOWS = f"""win AS (SELECT * FROM (SELECT idx AS pos, {_leads('word', None, 'idx')} FROM vocab)
  WHERE t{WINDOW} IS NOT NULL)"""
_INPUT = "concat_ws(',', " + ", ".join(f"t{i}" for i in range(WINDOW)) + ")"

_LATER = f"concat_ws(',', {', '.join(f'u{i}' for i in range(WINDOW))}) AS tokens"


def _second_level(source: str, token: str, order: str) -> str:
    ahead = ", ".join(f"lead({token}, {i}) OVER (PARTITION BY doc_id ORDER BY {order}) AS u{i}" for i in range(1, WINDOW))
    return f"""(SELECT doc_id, idx, {_LATER} FROM (SELECT doc_id, {order} AS idx, {token} AS u0, {ahead} FROM {source})
  WHERE u{WINDOW - 1} IS NOT NULL)"""


_FLATTENED = (
    f"""flat AS (SELECT doc_id, pos * {WINDOW} + p AS place, CASE p {" ".join(f"WHEN {p} THEN t{p}" for p in range(WINDOW))} END AS t
  FROM win, (SELECT unnest(range(0, {WINDOW})) AS p))""",
    f"flattened AS {_second_level('flat', 't', 'place')}",
)
_LABELLED = (f"labelled AS {_second_level('win', f't{WINDOW}', 'pos')}",)

# Pre-tokens and fixed-merge subwords.
_PRETOKENS = rf"""pre AS (
  SELECT doc_id, lang, unnest(regexp_extract_all({_STRIPPED}, '[a-z]+|[0-9]{{1,3}}')) AS piece FROM documents)"""
_PRE_FREQ = "prefreq AS (SELECT piece, count(*)::bigint AS frequency FROM pre GROUP BY piece)"


def _folded(text: str) -> str:
    for left, right in FIXED_MERGES:
        text = f"replace({text}, '<{left}><{right}>', '<{left}{right}>')"
    return f"regexp_extract_all({text}, '<([a-z0-9]+)>', 1)"


def _ids(name: str, merges: Merges) -> str:
    return f"{name}(token, word) AS (VALUES " + ", ".join(f"({i}, '{p}')" for i, p in enumerate(vocabulary(merges))) + ")"


_IDS = _ids("ids", FIXED_MERGES)
_DOC_PIECES = rf"""marks AS (
  SELECT doc_id, regexp_replace(array_to_string(regexp_extract_all({_STRIPPED}, '[a-z]+|[0-9]{{1,3}}'), ' '),
    '([a-z0-9])', '<\1>', 'g') AS m FROM documents),
lists AS (SELECT doc_id, {_folded('m')} AS ws FROM marks),
words AS (SELECT doc_id, word, token, pos FROM (
  SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS pos FROM lists) JOIN ids USING (word))"""


# Embedding, similarity and collation over a `words(doc_id, pos, word)` relation. `tok` is the token column.
def _cooccurrence(tok: str) -> str:
    offsets = "(SELECT unnest(range(1, {0})) AS d UNION ALL SELECT -unnest(range(1, {0})))".format(WINDOW + 1)
    return f"""kept AS (SELECT doc_id, pos, {tok} AS word FROM words),
shifted AS (SELECT doc_id, pos + d AS pos, word FROM kept, {offsets} o),
cooc AS (SELECT a.word, b.word AS context, count(*)::bigint AS n
  FROM shifted a JOIN kept b ON a.doc_id = b.doc_id AND a.pos = b.pos GROUP BY ALL)"""


_SIGNS = f"""contexts AS (SELECT DISTINCT context FROM cooc),
signs AS (SELECT context, d AS dim, CASE WHEN
  ((('0x' || substr(md5(concat(context, ':0')), 1, 13))::bigint >> d) & 1) = 1 THEN 1 ELSE -1 END AS sign
  FROM contexts, (SELECT unnest(range(0, {DIMS}))::int AS d))"""
_EMBEDDED = """emb AS (SELECT word, dim, sum(n * sign)::bigint AS value FROM cooc JOIN signs USING (context) GROUP BY word, dim)"""


def _neighbours(source: str, key: str, vector: str, width: int) -> str:
    """Top-k relation `sim(id, rank, similar_token, score)` over a relation with one vector per row.

    Each vector keeps its best k + 1 of all, itself among them or among their equals.
    """
    return f"""units AS (SELECT id, row_number() OVER (ORDER BY id) AS rn, n = 0 AS zero,
    list_transform(v, lambda x: CASE WHEN n = 0 THEN 0 ELSE x / n END)::double[{width}] AS u
  FROM (SELECT {key} AS id, {vector}::double[] AS v, sqrt(list_dot_product(v, v)) AS n FROM {source})),
near AS (SELECT a.rn, unnest(min_by(b.rn, (a.zero OR b.zero, -round(array_inner_product(a.u, b.u), 10), b.rn), {TOP_K + 1})) AS other
  FROM units a, units b GROUP BY a.rn),
pairs AS (SELECT a.id, b.id AS similar_token,
    CASE WHEN a.zero OR b.zero THEN 'nan'::double ELSE array_inner_product(a.u, b.u) END AS score
  FROM near JOIN units a USING (rn) JOIN units b ON near.other = b.rn WHERE near.other <> near.rn),
sim AS (SELECT id, rank, similar_token, score FROM (SELECT *, row_number() OVER (
    PARTITION BY id ORDER BY isnan(score), round(score, 10) DESC, similar_token)::int AS rank FROM pairs) WHERE rank <= {TOP_K})"""


_WIDE = "wide AS (SELECT word, list(value ORDER BY dim) AS vector FROM emb GROUP BY word)"
_SIM_VECTORS = _neighbours("embeddings", "vec_id", "embedding", VECTOR_SIZE)
_SIM_WORDS = _neighbours("wide", "word", "vector", DIMS)
_WORD_EMBEDDING = (*_WORD_PARTS, _FREQUENCY, _cooccurrence("word"), _SIGNS, _EMBEDDED)

_SIM_ID_LISTS = "simlist AS (SELECT id, string_agg(similar_token::varchar, ',' ORDER BY rank) AS similar_tokens FROM sim GROUP BY id)"

_WORD_CHAIN = (
    *_WORD_PARTS, _FREQUENCY, _VOCAB,
    _cooccurrence("word"), _SIGNS, _EMBEDDED, _WIDE,
    "numbered AS (SELECT idx AS token, vector FROM wide JOIN vocab USING (word))",
    _neighbours("numbered", "token", "vector", DIMS), _SIM_ID_LISTS,
)
_RECORD = """SELECT coalesce(f.word, 'N/A') AS word, coalesce(f.token, s.token) AS "intToken",
  coalesce(f.frequency, 0)::bigint AS frequency, coalesce(s.similar_tokens, 'N/A') AS similar_tokens
FROM f FULL OUTER JOIN s ON f.token = s.token"""

_OUTER_SIDES = (
    *_VOCAB_PARTS, _SIM_VECTORS, _SIM_ID_LISTS,
    "f AS (SELECT word, idx::varchar AS token, frequency FROM vocab)",
    "s AS (SELECT (CASE WHEN id % 2 = 0 THEN id ELSE -id END)::varchar AS token, similar_tokens FROM simlist)",
)

# Line formats, spelled out case by case.
_LINE_KINDS = """shaped AS (SELECT word, idx::varchar AS token, frequency, idx % 5 AS shape, idx % 7 = 3 AS bad FROM vocab)"""

ORACLES: dict[str, str] = {
    "normalised_text": rf"SELECT doc_id, rtrim(regexp_replace({_STRIPPED}, '[{_SPACE}]+', ' ', 'g'), ' ') AS text FROM documents",
    "word_occurrences": _with(*_WORD_PARTS, select="SELECT doc_id, pos, word FROM words"),
    "word_frequency": _with(*_WORD_PARTS, _FREQUENCY, select="SELECT word, frequency FROM freq"),
    "pretoken_frequency": _with(_PRETOKENS, _PRE_FREQ, select="SELECT piece, frequency FROM prefreq"),
    "subword_pair_counts": _with(
        _PRETOKENS,
        _PRE_FREQ,
        "chars AS (SELECT piece, frequency, unnest(range(1, length(piece))) AS i FROM prefreq)",
        select="""SELECT substr(piece, i, 1) AS "left", substr(piece, i + 1, 1) AS "right",
          sum(frequency)::bigint AS frequency FROM chars GROUP BY 1, 2""",
    ),
    "subword_frequency": _with(
        _PRETOKENS,
        _PRE_FREQ,
        _IDS,
        rf"""pieces AS (SELECT unnest({_folded(r"regexp_replace(piece, '(.)', '<\1>', 'g')")}) AS word, frequency FROM prefreq)""",
        select="SELECT word, token, sum(frequency)::bigint AS frequency FROM pieces JOIN ids USING (word) GROUP BY word, token",
    ),
    "subword_frequency_wide": _with(
        _PRETOKENS,
        _PRE_FREQ,
        _ids("wide", WIDE_MERGES),
        "steps AS (SELECT [" + ", ".join(f"'<{left}><{right}>|<{left}{right}>'" for left, right in WIDE_MERGES) + "] AS all_steps)",
        r"""merged AS (SELECT frequency, list_reduce(list_prepend(regexp_replace(piece, '(.)', '<\1>', 'g'), all_steps),
          lambda text, step: replace(text, split_part(step, '|', 1), split_part(step, '|', 2))) AS m FROM prefreq, steps)""",
        "pieces AS (SELECT unnest(regexp_extract_all(m, '<([a-z0-9]+)>', 1)) AS word, frequency FROM merged)",
        select="SELECT word, token, sum(frequency)::bigint AS frequency FROM pieces JOIN wide USING (word) GROUP BY word, token",
    ),
    "subword_occurrence_counts": _with(
        _IDS, _DOC_PIECES, select="SELECT token, count(*)::bigint AS frequency FROM words GROUP BY token"
    ),
    "subword_merges": _with(
        _PRETOKENS,
        _PRE_FREQ,
        rf"""bpe AS (
  SELECT 0 AS step, regexp_replace(piece, '(.)', '<\1>', 'g') AS m, frequency, '' AS l, '' AS r
  FROM prefreq WHERE length(piece) > 1
  UNION ALL
  SELECT step + 1, replace(m, '<' || best.l || '><' || best.r || '>', '<' || best.l || best.r || '>'), frequency, best.l, best.r
  FROM bpe, (SELECT l, r FROM (
      SELECT s[i] AS l, s[i + 1] AS r, frequency FROM (
        SELECT s, frequency, unnest(range(1, len(s))) AS i FROM (
          SELECT regexp_extract_all(m, '<([a-z0-9]+)>', 1) AS s, frequency FROM bpe)))
    GROUP BY l, r ORDER BY sum(frequency) DESC, l, r LIMIT 1) AS best
  WHERE step < {SUBWORD_PARAMS.n_merges})""",
        select="""SELECT DISTINCT (step - 1)::int AS rank, l AS "left", r AS "right" FROM bpe WHERE step > 0""",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
    "subword_conservation": """SELECT lang, sum(length(regexp_replace(lower(text), '[^a-z0-9]', '', 'g')))::bigint AS n_chars
      FROM documents GROUP BY lang""",
    "vocab_index": _with(*_VOCAB_PARTS, select="SELECT idx, word FROM vocab"),
    "context_windows_corpus": _with(
        *_WORD_PARTS, _CORPUS_WINDOWS, select=f"SELECT doc_id, pos, {_INPUT} AS input, t{WINDOW} AS label FROM win"
    ),
    "context_windows_listing": _with(
        *_VOCAB_PARTS,
        _LISTING_WORD_WINDOWS,
        select=f"SELECT pos AS window_id, {_INPUT} AS input, t{WINDOW} AS label FROM win",
    ),
    "flattened_windows": _with(*_WORD_PARTS, _CORPUS_WINDOWS, *_FLATTENED, select="SELECT * FROM flattened"),
    "label_windows": _with(*_WORD_PARTS, _CORPUS_WINDOWS, *_LABELLED, select="SELECT * FROM labelled"),
    "training_windows": _with(
        *_WORD_PARTS,
        _CORPUS_WINDOWS,
        *_FLATTENED,
        *_LABELLED,
        select="""SELECT tokens, count(*)::bigint AS weight FROM (SELECT tokens FROM flattened UNION ALL SELECT tokens FROM labelled)
          GROUP BY tokens""",
    ),
    "window_positions": _with(
        *_WORD_PARTS,
        _CORPUS_WINDOWS,
        "placed AS (" + " UNION ALL ".join(f"SELECT t{i} AS token, {i} AS position FROM win" for i in range(WINDOW)) + ")",
        select="SELECT token, position, count(*)::bigint AS n FROM placed GROUP BY token, position",
    ),
    "role_token_counts": _with(
        *_WORD_PARTS,
        _CORPUS_WINDOWS,
        "placed AS ("
        + " UNION ALL ".join(
            f"SELECT '{'label' if i == WINDOW else 'input'}' AS role, t{i} AS token FROM win" for i in range(WINDOW + 1)
        )
        + ")",
        select="SELECT role, token, count(*)::bigint AS n FROM placed GROUP BY role, token",
    ),
    "window_features": _with(
        *_VOCAB_PARTS,
        _LISTING_WINDOWS,
        select="SELECT pos AS window_id, "
        + ", ".join(f"round(t{i}::double / (SELECT max(idx) FROM vocab), 8) AS f{i}" for i in range(WINDOW))
        + " FROM win",
    ),
    "vector_norms": """SELECT vec_id, round(sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))), 6) AS norm
      FROM embeddings""",
    "mean_vectors": """SELECT label, dim, round(avg(x::double), 6) AS mean FROM (
      SELECT label, unnest(embedding) AS x, (generate_subscripts(embedding, 1) - 1)::int AS dim FROM embeddings)
      GROUP BY label, dim""",
    "vector_cosine": _with(
        """long AS (SELECT label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings)""",
        "mean AS (SELECT label, dim, avg(x) AS m FROM long GROUP BY label, dim)",
        "centre AS (SELECT label, list(m ORDER BY dim) AS c FROM mean GROUP BY label)",
        select="""SELECT vec_id, label, round(list_cosine_similarity(embedding::double[], c), 4) AS score
          FROM embeddings JOIN centre USING (label)""",
    ),
    "dedup_vectors": _with(
        """tagged AS (SELECT vec_id // 3 AS token, CASE WHEN label % 2 = 0 THEN 'input' ELSE 'label' END AS role, embedding
          FROM embeddings)""",
        "best AS (SELECT *, row_number() OVER (PARTITION BY token ORDER BY role, embedding) AS rn FROM tagged)",
        select="""SELECT token, role,
          round(sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))), 6) AS norm FROM best WHERE rn = 1""",
    ),
    "top_similar_vectors": _with(
        _SIM_VECTORS, select="SELECT id AS vec_id, rank, similar_token, round(score, 4) AS score FROM sim"
    ),
    "cooccurrence_counts": _with(
        *_WORD_PARTS, _FREQUENCY, _cooccurrence("word"), select="SELECT word, context, n FROM cooc"
    ),
    "token_embeddings": _with(*_WORD_EMBEDDING, select="SELECT word, dim, value FROM emb"),
    "token_embeddings_from_counts": _with(*_WORD_EMBEDDING, select="SELECT word, dim, value FROM emb"),
    "top_similar_tokens": _with(
        *_WORD_EMBEDDING,
        _WIDE,
        _SIM_WORDS,
        select="SELECT id AS word, rank, similar_token, round(score, 4) AS score FROM sim",
    ),
    "collated_statistics": _with(
        *_WORD_CHAIN,
        "f AS (SELECT word, idx::varchar AS token, frequency FROM vocab)",
        "s AS (SELECT id::varchar AS token, similar_tokens FROM simlist)",
        select=_RECORD,
    ),
    "collated_subwords": _with(
        _IDS,
        _DOC_PIECES,
        _cooccurrence("token"),
        _SIGNS,
        _EMBEDDED,
        _WIDE,
        _SIM_WORDS,
        _SIM_ID_LISTS,
        "f AS (SELECT word, token::varchar AS token, count(*)::bigint AS frequency FROM words GROUP BY word, token)",
        "s AS (SELECT id::varchar AS token, similar_tokens FROM simlist)",
        select=_RECORD,
    ),
    "collated_outer": _with(*_OUTER_SIDES, select=_RECORD),
    "collated_repeats": _with(
        *_VOCAB_PARTS,
        _SIM_VECTORS,
        """f AS (SELECT best.word AS word, token, best.frequency AS frequency FROM (
          SELECT (idx // 2)::varchar AS token, max({'frequency': frequency, 'word': word}) AS best FROM vocab GROUP BY 1))""",
        "single AS (SELECT id, list(similar_token::varchar ORDER BY rank) AS l FROM sim GROUP BY id)",
        """s AS (SELECT (id // 2)::varchar AS token, array_to_string(flatten(list_sort(list(l))), ',') AS similar_tokens
          FROM single GROUP BY 1)""",
        select=_RECORD,
    ),
    "tagged_union": _with(
        *_OUTER_SIDES,
        select=r"""SELECT 'tokenization' AS source, token, word || chr(9) || frequency::varchar AS payload FROM f
          UNION ALL SELECT 'semantic_similarity', token, similar_tokens FROM s""",
    ),
    "ordered_output": _with(
        *_VOCAB_PARTS,
        select="""SELECT word, idx::varchar AS token, row_number() OVER (ORDER BY idx::varchar) - 1 AS place FROM vocab""",
    ),
    "report_json": _with(
        *_OUTER_SIDES,
        f"rec AS ({_RECORD})",
        select="""SELECT "intToken" AS token, CASE WHEN similar_tokens = 'N/A'
          THEN to_json({'word': word, 'intToken': "intToken", 'frequency': frequency})::varchar
          ELSE to_json({'word': word, 'intToken': "intToken", 'frequency': frequency,
            'semanticallySimilarTokens': string_split(similar_tokens, ',')})::varchar END AS text FROM rec""",
    ),
    "report_yaml": _with(
        *_OUTER_SIDES,
        f"rec AS ({_RECORD})",
        select="""SELECT "intToken" AS token, 'word: "' || word || '"' || chr(10) || 'intToken: "' || "intToken" || '"' || chr(10)
          || 'frequency: ' || frequency::varchar || chr(10) || 'semanticallySimilarTokens: '
          || CASE WHEN similar_tokens = 'N/A' THEN '"N/A"' ELSE '["' || replace(similar_tokens, ',', '", "') || '"]' END || chr(10) AS text
          FROM rec""",
    ),
    "stage_counts": _with(
        *_WORD_CHAIN,
        "sizes AS (SELECT len(ws) AS n FROM lists)",
        select=f"""SELECT 'tokenization' AS stage, count(*)::bigint AS n FROM vocab
          UNION ALL SELECT 'sliding_window', sum(greatest(0, n - {WINDOW}))::bigint FROM sizes
          UNION ALL SELECT 'embedding', count(*)::bigint FROM numbered
          UNION ALL SELECT 'semantic_similarity', count(*)::bigint FROM sim
          UNION ALL SELECT 'statistics_collated', count(*)::bigint FROM vocab""",
    ),
    "tsv_parse_tokens": _with(*_VOCAB_PARTS, _LINE_KINDS, select="SELECT token FROM shaped WHERE shape <> 3"),
    "tsv_parse_frequencies": _with(
        *_VOCAB_PARTS, _LINE_KINDS, select="SELECT word, token, frequency FROM shaped WHERE shape IN (0, 4) AND NOT bad"
    ),
    "tsv_parse_windows": _with(
        *_VOCAB_PARTS,
        _LISTING_WINDOWS,
        select=f"SELECT pos::varchar AS idx, {_INPUT} AS input, t{WINDOW}::int AS label FROM win",
    ),
    "tsv_parse_vectors": """SELECT vec_id::varchar AS token, (generate_subscripts(embedding, 1) - 1)::int AS dim,
      unnest(embedding)::double AS value FROM embeddings WHERE vec_id % 3 <> 0""",
    "packed_vectors": """SELECT vec_id::varchar AS token,
      round(sqrt(list_sum(list_transform(embedding::double[], lambda x: x * x))), 6) AS norm FROM embeddings""",
    "tsv_parse_similar": _with(
        _SIM_VECTORS,
        select=f"""SELECT id::varchar AS token, rank - 1 AS place, similar_token::varchar AS similar_token FROM sim
          UNION ALL SELECT id::varchar, count(*)::int, 'N/A' FROM sim GROUP BY id""",
    ),
    "tsv_render_tokens": _with(
        *_VOCAB_PARTS,
        select="SELECT word || chr(9) || idx::varchar || chr(9) || frequency::varchar AS value FROM vocab",
    ),
    "tsv_render_windows": _with(
        *_VOCAB_PARTS,
        _LISTING_WINDOWS,
        select=f"""SELECT 'input_' || pos::varchar || chr(9) || {_INPUT} AS value FROM win
          UNION ALL SELECT 'label_' || pos::varchar || chr(9) || t{WINDOW}::varchar FROM win""",
    ),
    "tsv_render_vectors": """SELECT vec_id::varchar || chr(9) || '[' ||
      array_to_string(list_transform(embedding::double[], lambda x: printf('%.6f', x)), ', ') || ']' AS value FROM embeddings""",
    "tsv_render_similar": _with(
        _SIM_VECTORS,
        select="""SELECT id::varchar || chr(9) || string_agg(similar_token::varchar || '(' || printf('%.4f', score) || ')', ','
          ORDER BY rank) AS value FROM sim GROUP BY id""",
    ),
    "malformed_counts": _with(
        *_VOCAB_PARTS,
        _LINE_KINDS,
        select=f"""SELECT 'tokens' AS format, count(*) FILTER (shape <> 3)::bigint AS n_ok, count(*) FILTER (shape = 3)::bigint AS n_bad
          FROM shaped
          UNION ALL SELECT 'frequencies', count(*) FILTER (shape IN (0, 4) AND NOT bad),
            count(*) FILTER (shape NOT IN (0, 4) OR bad) FROM shaped
          UNION ALL SELECT 'windows', 2 * greatest(0, count(*) - {WINDOW}), greatest(0, count(*) - {WINDOW}) FROM vocab
          UNION ALL SELECT 'vectors', count(*) FILTER (vec_id % 3 <> 0), count(*) FILTER (vec_id % 3 = 0) FROM embeddings""",
    ),
}

_BENCHMARK_CHAIN = (
    _WORD_LISTS.replace("FROM documents", "FROM (SELECT item_id AS doc_id, text FROM benchmark)"),
    _WORDS, _FREQUENCY, _VOCAB,
    "listed AS (SELECT 0 AS doc_id, idx AS pos, idx::varchar AS word FROM vocab)",
    _cooccurrence("word").replace("FROM words", "FROM listed"), _SIGNS, _EMBEDDED, _WIDE, _SIM_WORDS, _SIM_ID_LISTS,
    "f AS (SELECT word, idx::varchar AS token, frequency FROM vocab)",
    "s AS (SELECT id AS token, similar_tokens FROM simlist)",
    f"rec AS ({_RECORD})",
)

# The same answers, whether the text comes as a table or as lines.
ORACLES |= {
    "files_tokenised": _with(*_VOCAB_PARTS, select="SELECT word, idx::varchar AS token, frequency FROM vocab"),
    "files_windows": ORACLES["tsv_render_windows"],
    "files_similar": _with(
        _SIM_VECTORS, select="SELECT id::varchar AS token, count(*)::bigint AS n_similar FROM sim GROUP BY id"
    ),
    "files_overwritten": _with(
        *_VOCAB_PARTS,
        select="SELECT 3::bigint AS n_files, count(*)::bigint AS n_lines, min(word) AS first, max(word) AS last FROM vocab",
    ),
    "files_after_failure": _with(*_VOCAB_PARTS, select="SELECT word, idx::varchar AS token, frequency FROM vocab"),
    "files_splits": """SELECT split_mb::int AS split_mb, (sum(strlen(text) + 1) + split_mb * 1048576 - 1)::bigint // (split_mb * 1048576) AS n_splits,
      sum(length(text) - length(replace(text, chr(10), '')) + 1)::bigint AS n_lines
      FROM documents, (SELECT unnest([1, 2, 4]) AS split_mb) GROUP BY split_mb""",
    "files_report": _with(
        *_VOCAB_PARTS,
        select="""SELECT 'word: "' || word || '"' || chr(10) || 'intToken: "' || idx::varchar || '"' || chr(10)
          || 'frequency: ' || frequency::varchar || chr(10) || 'semanticallySimilarTokens: "N/A"' AS record FROM vocab""",
    ),
    "files_chain": _with(
        *_BENCHMARK_CHAIN,
        select="""SELECT 'word: "' || word || '"' || chr(10) || 'intToken: "' || "intToken" || '"' || chr(10)
          || 'frequency: ' || frequency::varchar || chr(10) || 'semanticallySimilarTokens: '
          || CASE WHEN similar_tokens = 'N/A' THEN '"N/A"' ELSE '["' || replace(similar_tokens, ',', '", "') || '"]' END AS record
          FROM rec""",
    ),
}
