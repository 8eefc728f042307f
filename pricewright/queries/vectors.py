"""Tokens, TF-IDF, reduction, sentiment and feature scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright import fixed
from pricewright.functions import text as X
from pricewright.functions.sentiment import TOKEN, add_scores
from pricewright.operators import vectorize as V
from pricewright.operators.evaluate import aggregate_importance
from pricewright.operators.features import labelled_sentiment
from pricewright.operators.folds import add_fold
from pricewright.operators.incremental import Summary, fit_incremental
from pricewright.operators.information import neighbour_information
from pricewright.operators.parse import parse_labelled
from pricewright.operators.reduce import fit_projection, gram
from pricewright.operators.selection import f_regression, mutual_information, select_k_best
from pricewright.operators.sketch import fit_sketched
from pricewright.queries import sql as Q
from pricewright.queries.numbers import LINE_KEY, rounded
from pricewright.queries.registry import query
from pricewright.session import materialise, new_table_path
from pricewright.sources.tables import catalog, catalog_line, table

_KEY = ", ".join(LINE_KEY)
_STOPS = "[" + ", ".join(f"'{w}'" for w in fixed.ENGLISH_STOP_WORDS) + "]"
TOKENS = f"regexp_extract_all(lower(coalesce(text, '')), '{fixed.TOKEN}')"
KEPT = f"list_filter({TOKENS}, lambda w: NOT list_contains({_STOPS}, w))"

PLAIN = V.TextSettings(max_features=300, min_df=8, max_df=0.85)
STOPPED = V.detailed_text(fixed.ENGLISH_STOP_WORDS)
SMALL = V.TextSettings(max_features=60, min_df=8, max_df=0.85)


def documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "text")


@query("tokenize", f"SELECT doc_id, CAST(len({TOKENS}) AS INT) AS n_tokens, array_to_string({TOKENS}, ' ') AS tokens FROM documents")
def tokenize(spark, sf):
    words = X.tokens(F.col("text"))
    return documents(spark, sf).select("doc_id", F.size(words).alias("n_tokens"), F.array_join(words, " ").alias("tokens"))


@query("strip_accents", "SELECT doc_id, strip_accents(text) AS plain FROM documents")
def strip_accents(spark, sf):
    return documents(spark, sf).select("doc_id", X.strip_accents(F.col("text")).alias("plain"))


@query("stopwords", f"""
SELECT doc_id, array_to_string(list_filter(regexp_extract_all(strip_accents(lower(coalesce(text, ''))), '{fixed.TOKEN}'),
  lambda w: NOT list_contains({_STOPS}, w)), ' ') AS tokens FROM documents""")
def stopwords(spark, sf):
    """Accents stripped, then stop words removed."""
    return V.add_tokens(documents(spark, sf), "text", STOPPED).select("doc_id", F.array_join("tokens", " ").alias("tokens"))


# n-grams of one and two words, per document.
GRAMS = f"""tok AS (SELECT doc_id, {TOKENS} AS t FROM documents),
grams AS (SELECT doc_id, list_concat(t, CASE WHEN len(t) > 1
  THEN list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]) ELSE [] END) AS g FROM tok)"""


@query("ngrams", f"WITH {GRAMS} SELECT doc_id, array_to_string(g, '|') AS grams FROM grams")
def ngrams(spark, sf):
    return V.add_grams(documents(spark, sf), "text", PLAIN).select("doc_id", F.array_join("grams", "|").alias("grams"))


def _vocabulary_sql(source: str, settings: V.TextSettings) -> str:
    return f"""size AS (SELECT count(*) AS n FROM {source}),
each AS (SELECT doc_id, unnest(g) AS term FROM {source}),
stat AS (SELECT term, count(*) AS uses, count(DISTINCT doc_id) AS docs FROM each GROUP BY term),
vocab AS (SELECT term, uses, docs FROM stat, size WHERE docs >= {settings.min_df} AND docs <= {settings.max_df} * n
  ORDER BY uses DESC, term LIMIT {settings.max_features})"""


def _tfidf_sql(name: str, source: str) -> str:
    """Weights of ``source`` documents under the vocabulary ``vocab`` of ``size`` documents."""
    return f"""{name}_tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(g) AS term FROM {source}) GROUP BY doc_id, term),
{name}_w AS (SELECT doc_id, term, (1 + ln(tf)) * (ln((1 + n) / (1 + docs)) + 1) AS w FROM {name}_tf JOIN vocab USING (term), size),
{name} AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM {name}_w)"""


@query("vocabulary", f"WITH {GRAMS}, {_vocabulary_sql('grams', PLAIN)} SELECT * FROM vocab")
def vocabulary(spark, sf):
    docs = documents(spark, sf)
    return V.vocabulary(docs, "text", PLAIN, docs.count()).select("term", "uses", "docs")


@query("term_statistics", f"WITH {GRAMS}, {_vocabulary_sql('grams', PLAIN)} SELECT term, uses, docs FROM stat")
def term_statistics(spark, sf):
    return V.term_statistics(documents(spark, sf), "text", PLAIN)


@query("tfidf", f"""
WITH {GRAMS}, {_vocabulary_sql('grams', PLAIN)}, {_tfidf_sql('tfidf', 'grams')}
SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf""")
def tfidf(spark, sf):
    docs = documents(spark, sf)
    return rounded(V.fit_tfidf(docs, "text", PLAIN).long_form(docs, "doc_id", "text"), ["doc_id", "term"], ["weight"])


@query("tfidf_transform", f"""
WITH {GRAMS}, f AS (SELECT *, {Q.fold('doc_id', 5)} AS fold FROM grams),
seen AS (SELECT * FROM f WHERE fold <> 0), fresh AS (SELECT * FROM f WHERE fold = 0),
{_vocabulary_sql('seen', PLAIN)}, {_tfidf_sql('tfidf', 'fresh')}
SELECT doc_id, term, round(weight, 6) AS weight FROM tfidf""")
def tfidf_transform(spark, sf):
    """Vocabulary and idf of four folds, applied to the fifth."""
    docs = add_fold(documents(spark, sf), 5, "doc_id")
    model = V.fit_tfidf(docs.where("fold <> 0"), "text", PLAIN)
    return rounded(model.long_form(docs.where("fold = 0"), "doc_id", "text"), ["doc_id", "term"], ["weight"])


@query("text_gram", f"""
WITH {GRAMS}, {_vocabulary_sql('grams', SMALL)}, {_tfidf_sql('tfidf', 'grams')},
num AS (SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INT) AS idx FROM vocab),
x AS (SELECT doc_id, idx, weight FROM tfidf JOIN num USING (term))
SELECT a.idx AS i, b.idx AS j, round(sum(a.weight * b.weight), 6) AS product FROM x a JOIN x b USING (doc_id) GROUP BY a.idx, b.idx""")
def text_gram(spark, sf):
    """The matrix that both reductions are read from: products of all pairs of term columns."""
    docs = documents(spark, sf)
    model = V.fit_tfidf(docs, "text", SMALL)
    _, _, products = gram(model.transform(docs, "text"), "tfidf", len(model.terms))
    cells = [(i, j, float(x)) for i, row in enumerate(products) for j, x in enumerate(row) if x != 0]  # at most 60 x 60
    return spark.createDataFrame(cells, "i int, j int, product double").select("i", "j", F.round("product", 6).alias("product"))


def _reduced(spark, sf, centred: bool, k: int, settings: V.TextSettings = PLAIN):
    docs = documents(spark, sf)
    model = V.fit_tfidf(docs, "text", settings)
    vectors = materialise(model.transform(docs, "text").select("doc_id", "tfidf"), "tfidf")
    fitted = fit_projection(vectors, "tfidf", len(model.terms), k, centred)
    squares = F.aggregate("reduced", F.lit(0.0), lambda acc, x: acc + x * x)
    return fitted.transform(vectors, "tfidf", "reduced").select(
        "doc_id", F.round(squares, 6).alias("squared_norm"), "reduced"
    )


@query("svd_text")
def svd_text(spark, sf):
    """Each document's 20 leading coordinates; signs are a convention, so there is no SQL twin."""
    reduced = _reduced(spark, sf, centred=False, k=20)
    return reduced.select("doc_id", "squared_norm", *[F.round(F.col("reduced")[i], 6).alias(f"text_{i}") for i in range(20)])


@query("svd_text_isometry", f"""
WITH {GRAMS}, {_vocabulary_sql('grams', PLAIN)}, {_tfidf_sql('tfidf', 'grams')}
SELECT doc_id, round(coalesce(sum(weight * weight), 0), 6) + 0.0 AS squared_norm FROM grams LEFT JOIN tfidf USING (doc_id) GROUP BY doc_id""")
def svd_text_isometry(spark, sf):
    """With every component kept, the rotation keeps the length of each vector."""
    return _reduced(spark, sf, centred=False, k=PLAIN.max_features).select("doc_id", (F.col("squared_norm") + 0.0).alias("squared_norm"))


@query("pca_text")
def pca_text(spark, sf):
    reduced = _reduced(spark, sf, centred=True, k=20)
    return reduced.select("doc_id", "squared_norm", *[F.round(F.col("reduced")[i], 6).alias(f"tfidf_pca_{i}") for i in range(20)])


@query("pca_text_distance", f"""
WITH {GRAMS}, {_vocabulary_sql('grams', PLAIN)}, {_tfidf_sql('tfidf', 'grams')},
mean AS (SELECT term, sum(weight) / (SELECT n FROM size) AS m FROM tfidf GROUP BY term),
cross_term AS (SELECT doc_id, sum(weight * weight) AS ww, sum(weight * m) AS wm FROM tfidf JOIN mean USING (term) GROUP BY doc_id)
SELECT doc_id, round(coalesce(ww, 0) - 2 * coalesce(wm, 0) + (SELECT sum(m * m) FROM mean), 6) AS squared_norm
FROM grams LEFT JOIN cross_term USING (doc_id)""")
def pca_text_distance(spark, sf):
    """With every component kept, the length of a projection is the distance to the mean vector."""
    return _reduced(spark, sf, centred=True, k=PLAIN.max_features).select("doc_id", "squared_norm")


def _cosines(reduced, k: int):
    """(i, j, cosine) of all pairs of the k coordinates over the rows: at most k x k numbers, by sums only."""
    pairs = F.flatten(F.transform("reduced", lambda x, i: F.transform("reduced", lambda y, j: F.struct(i.alias("i"), j.alias("j"), (x * y).alias("xy")))))
    sums = reduced.select(F.inline(pairs)).groupBy("i", "j").agg(F.sum("xy").alias("xy"))
    own = sums.where("i = j").select(F.col("i").alias("at"), F.col("xy").alias("square"))
    both = sums.join(own, F.col("i") == F.col("at")).drop("at").join(own.withColumnRenamed("square", "other"), F.col("j") == F.col("at"))
    return both.select("i", "j", (F.round(F.col("xy") / F.sqrt(F.col("square") * F.col("other")), 6) + 0.0).alias("cosine"))


def _identity_sql(k: int) -> str:
    return (f"SELECT CAST(i AS INT) AS i, CAST(j AS INT) AS j, CASE WHEN i = j THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS cosine "
            f"FROM range({k}) a(i), range({k}) b(j)")


@query("svd_text_orthogonal", _identity_sql(12))
def svd_text_orthogonal(spark, sf):
    """The coordinates of a truncated SVD are orthogonal over the rows, with fewer components than terms."""
    return _cosines(_reduced(spark, sf, centred=False, k=12, settings=V.LABELLED_TEXT), 12)


@query("pca_text_orthogonal", _identity_sql(12))
def pca_text_orthogonal(spark, sf):
    return _cosines(_reduced(spark, sf, centred=True, k=12, settings=STOPPED), 12)


def _tfidf(spark, sf, settings):
    docs = documents(spark, sf)
    model = V.fit_tfidf(docs, "text", settings)
    return materialise(model.transform(docs, "text").select("doc_id", "tfidf"), "tfidf"), len(model.terms)


@query("svd_sketched_values", "SELECT CAST(i AS INT) AS i, 0.0::DOUBLE AS relative_difference FROM range(20) t(i)")
def svd_sketched_values(spark, sf):
    """The 20 largest singular values of 300 terms by a random sketch, against those of the Gram matrix."""
    vectors, width = _tfidf(spark, sf, PLAIN)
    sketched, whole = fit_sketched(vectors, "tfidf", width, 20).singular_values, fit_projection(vectors, "tfidf", width, 20, False).singular_values
    rows = [(i, abs(float(a / b - 1))) for i, (a, b) in enumerate(zip(sketched, whole))]  # 20 numbers
    return spark.createDataFrame(rows, "i int, d double").select("i", F.round("d", 6).alias("relative_difference"))


MANY = V.TextSettings(max_features=20_000, min_df=1, max_df=0.9)


@query("svd_many_terms_orthogonal", _identity_sql(8))
def svd_many_terms_orthogonal(spark, sf):
    """Eight coordinates over 20,000 terms, far more than a Gram matrix is taken of."""
    vectors, width = _tfidf(spark, sf, MANY)
    return _cosines(fit_projection(vectors, "tfidf", width, 8, False).transform(vectors, "tfidf", "reduced"), 8)


@query("pca_incremental_distance", f"""
WITH {GRAMS}, {_vocabulary_sql('grams', SMALL)}, {_tfidf_sql('tfidf', 'grams')},
mean AS (SELECT term, sum(weight) / (SELECT n FROM size) AS m FROM tfidf GROUP BY term),
cross_term AS (SELECT doc_id, sum(weight * weight) AS ww, sum(weight * m) AS wm FROM tfidf JOIN mean USING (term) GROUP BY doc_id)
SELECT doc_id, round(coalesce(ww, 0) - 2 * coalesce(wm, 0) + (SELECT sum(m * m) FROM mean), 6) AS squared_norm
FROM grams LEFT JOIN cross_term USING (doc_id)""")
def pca_incremental_distance(spark, sf):
    """A summary of four fifths of the documents, saved, loaded and updated with the rest, keeps the distances to the mean of all."""
    vectors, width = _tfidf(spark, sf, SMALL)
    parts = add_fold(vectors, 5, "doc_id")
    path = new_table_path(spark, "summary")
    fit_incremental(parts.where("fold <> 0"), "tfidf", width, width).save(path, spark)
    summary = fit_incremental(parts.where("fold = 0"), "tfidf", width, width, start=Summary.load(path, spark))
    squares = F.aggregate("reduced", F.lit(0.0), lambda acc, x: acc + x * x)
    return summary.projection().transform(vectors, "tfidf", "reduced").select("doc_id", F.round(squares, 6).alias("squared_norm"))


_LEXICON = "lexicon(word, polarity, subjectivity) AS (VALUES " + ", ".join(
    f"('{w}', {p}::DOUBLE, {s}::DOUBLE)" for w, (p, s) in fixed.SENTIMENT_LEXICON.items()) + ")"


@query("sentiment", f"""
WITH {Q.LABELLED}, {_LEXICON},
words AS (SELECT sample_id, unnest(regexp_extract_all(lower(item_name), '{fixed.TOKEN}')) AS word FROM parsed),
scored AS (SELECT sample_id, avg(polarity) AS s FROM words JOIN lexicon USING (word) GROUP BY sample_id)
SELECT sample_id, round(coalesce(s, 0), 6) AS sentiment FROM parsed LEFT JOIN scored USING (sample_id)""")
def sentiment(spark, sf):
    return rounded(labelled_sentiment(parse_labelled(catalog(spark, sf))), ["sample_id"], ["sentiment"])


@query("sentiment_documents", f"""
WITH {_LEXICON}, tok AS (SELECT doc_id, {TOKENS} AS t FROM documents), words AS (SELECT doc_id, unnest(t) AS word FROM tok),
scored AS (SELECT doc_id, avg(polarity) AS p, avg(subjectivity) AS s FROM words JOIN lexicon USING (word) GROUP BY doc_id)
SELECT doc_id, round(coalesce(p, 0), 6) AS polarity, round(coalesce(s, 0), 6) AS subjectivity FROM documents LEFT JOIN scored USING (doc_id)""")
def sentiment_documents(spark, sf):
    words = X.tokens(F.col("text"))
    scores = [F.round(X.sentiment(words, fixed.SENTIMENT_LEXICON, w), 6).alias(w) for w in ("polarity", "subjectivity")]
    return documents(spark, sf).select("doc_id", *scores)


#: Opinions on parts, in SQL that Spark and DuckDB both run.
_OPINIONS = """SELECT p_partkey AS sample_id, CASE p_partkey % 9 WHEN 0 THEN 'Not a good' WHEN 1 THEN 'It really is great, this' WHEN 2 THEN 'Very bad, never fresh!'
  WHEN 3 THEN 'Isn''t the best' WHEN 4 THEN 'GOOD!! But not very' WHEN 5 THEN 'Truly so nice' WHEN 6 THEN 'Too small; quite' WHEN 7 THEN 'Without any' ELSE '' END
  || ' ' || lower(p_type) || CASE p_size % 6 WHEN 0 THEN '. Slightly cheap' WHEN 1 THEN ' wonderful!' WHEN 2 THEN ' not. Excellent' WHEN 3 THEN ' most difficult, no?' WHEN 4 THEN ' a light' ELSE ' strong' END
  || CASE WHEN p_partkey % 4 = 0 THEN ' and rather ' || lower(p_name) || ' perfect!' ELSE '' END AS opinion FROM {part}"""


def _modifier_sql() -> str:
    """The same rules as a fold over structs that hold a token's numbers and the state side by side."""
    table = {**{w: [p, s, 0.0, 1.0] for w, (p, s) in fixed.SENTIMENT_LEXICON.items()}, **{w: [0.0, 0.0, i, 0.0] for w, i in fixed.INTENSITIES.items()}}
    words = "MAP {" + ", ".join(f"'{w}': {x}::DOUBLE[]" for w, x in table.items()) + "}"
    no = "[" + ", ".join(f"'{w}'" for w in fixed.NEGATIONS) + "]"
    cut = "greatest(-1.0, least(1.0, {}))"
    state = "polarity: {}, subjectivity: {}, n: {}, last: {}, boost: {}, negated: {}, w: {}, x: {}, no: {}"
    token = state.format("0.0::DOUBLE", "0.0::DOUBLE", "0.0::DOUBLE", "0.0::DOUBLE", "1.0::DOUBLE", "false", "w", f"coalesce(({words})[w], [0, 0, 0, 0]::DOUBLE[])", f"(list_contains({no}, w) OR regexp_matches(w, 'n[''’]t$'))")
    scored, adverb, ends = "b.x[4] = 1", "b.x[3] > 0", "list_contains(['.', '?', ';', '!'], b.w)"
    polarity = f"({cut.format('b.x[1] * a.boost')} * CASE WHEN a.negated THEN -0.5 ELSE 1.0 END)"
    louder = f"CASE WHEN b.w = '!' AND a.n > 0 THEN {cut.format('a.last * 1.25')} ELSE a.last END"
    after = state.format(
        f"a.polarity + CASE WHEN {scored} THEN {polarity} ELSE {louder} - a.last END",
        f"a.subjectivity + CASE WHEN {scored} THEN {cut.format('b.x[2] * a.boost')} ELSE 0 END", f"a.n + ({scored})::INT",
        f"CASE WHEN {scored} THEN {polarity} ELSE {louder} END",
        f"CASE WHEN {adverb} THEN CASE WHEN {scored} THEN 1 ELSE a.boost END * b.x[3] WHEN {scored} OR {ends} THEN 1 WHEN length(b.w) <= 2 OR b.no THEN a.boost ELSE 1 END",
        f"CASE WHEN b.no THEN true WHEN {scored} OR {ends} THEN false WHEN {adverb} OR length(b.w) = 1 THEN a.negated ELSE false END", "b.w", "b.x", "b.no")
    pattern = TOKEN.replace("'", "''")
    return f"""tokens AS (SELECT sample_id, regexp_extract_all(lower(opinion), '{pattern}') AS t FROM opinions),
folded AS (SELECT sample_id, list_reduce(list_prepend({{{token.replace(', w: w,', ", w: '',").replace('[w]', "['']").replace(', w)', ", '')").replace('(w,', "('',")}}}, list_transform(t, lambda w: {{{token}}})), lambda a, b: {{{after}}}) AS s FROM tokens)
SELECT sample_id, round(CASE WHEN s.n > 0 THEN s.polarity / s.n ELSE 0 END, 6) + 0.0 AS polarity, round(CASE WHEN s.n > 0 THEN s.subjectivity / s.n ELSE 0 END, 6) AS subjectivity FROM folded"""


@query("sentiment_modifiers", f"WITH opinions AS ({_OPINIONS.format(part='part')}), {_modifier_sql()}")
def sentiment_modifiers(spark, sf):
    """Sentiment under adverbs, negations and exclamation marks, which end with their sentence."""
    rows = spark.sql(_OPINIONS, part=table(spark, sf, "part"))
    found = add_scores(rows, "opinion", "s")
    return found.select("sample_id", (F.round("s_polarity", 6) + 0.0).alias("polarity"), F.round("s_subjectivity", 6).alias("subjectivity"))


# ---- feature scores over line items ----

FEATURES = ["value", "pack_count", "name_length", "supplier", "line", "constant"]


def line_features(spark, sf):
    return catalog_line(spark, sf).select(
        *LINE_KEY, "price", "value", "pack_count", F.length("item_name").alias("name_length"),
        F.col("l_suppkey").alias("supplier"), F.col("l_linenumber").alias("line"), F.lit(1.0).alias("constant"),
    )


FEATURE_ROWS = f"""{Q.LINE}, feat AS (SELECT {_KEY}, price, value, CAST(pack_count AS DOUBLE) AS pack_count,
  CAST(length(item_name) AS DOUBLE) AS name_length, CAST(l_suppkey AS DOUBLE) AS supplier, CAST(l_linenumber AS DOUBLE) AS line, 1.0::DOUBLE AS constant FROM line)"""
_LONG = f"""{FEATURE_ROWS}, long AS (SELECT {Q.fold('l_orderkey', 3)} AS fold, price AS y, unnest([{', '.join(f"'{f}'" for f in FEATURES)}]) AS feature,
  unnest([{', '.join(FEATURES)}]) AS x FROM feat)"""


def _f_sql(by: str) -> str:
    return f"""m AS (SELECT {by}, count(x) AS n, covar_pop(x, y) AS sxy, var_pop(x) AS sxx, var_pop(y) AS syy, min(x) < max(x) AND min(y) < max(y) AS varies FROM long GROUP BY {by}),
r AS (SELECT {by}, n, CASE WHEN varies THEN sxy * sxy / (sxx * syy) END AS r2 FROM m),
score AS (SELECT {by}, r2 / (1 - r2) * (n - 2) AS score FROM r)"""


@query("f_regression", f"WITH {_LONG}, {_f_sql('feature')} SELECT feature, round(score, 4) AS score FROM score")
def f_scores(spark, sf):
    return rounded(f_regression(line_features(spark, sf), FEATURES, "price"), ["feature"], ["score"], 4)


@query("select_k_best", f"""
WITH {_LONG}, {_f_sql('feature')} SELECT feature, round(score, 4) AS score FROM (SELECT * FROM score ORDER BY score DESC NULLS LAST, feature LIMIT 3)""")
def k_best(spark, sf):
    return rounded(select_k_best(f_regression(line_features(spark, sf), FEATURES, "price"), 3), ["feature"], ["score"], 4)


_CUTS = "[" + ", ".join(str(i / 16) for i in range(1, 16)) + "]"


@query("mutual_information", f"""
WITH {_LONG}, xe AS (SELECT feature, quantile_cont(x, {_CUTS}) AS e FROM long GROUP BY feature), ye AS (SELECT quantile_cont(price, {_CUTS}) AS e FROM line),
binned AS (SELECT long.feature, len(list_filter(xe.e, lambda c: c < x)) AS bx, len(list_filter(ye.e, lambda c: c < y)) AS bin_y
  FROM long JOIN xe ON long.feature = xe.feature, ye),
cell AS (SELECT feature, bx, bin_y, count(*) AS c FROM binned GROUP BY ALL),
marg AS (SELECT *, sum(c) OVER (PARTITION BY feature) AS n, sum(c) OVER (PARTITION BY feature, bx) AS cx, sum(c) OVER (PARTITION BY feature, bin_y) AS cy FROM cell)
SELECT feature, round(sum(c / n * ln(c::DOUBLE * n / (cx::DOUBLE * cy))), 6) + 0.0 AS score FROM marg GROUP BY feature""")
def mi_scores(spark, sf):
    scores = mutual_information(line_features(spark, sf), FEATURES, "price")
    return scores.select("feature", (F.round("score", 6) + 0.0).alias("score"))


_PART_FEATURES = ["size", "name_length", "retail"]
_SPREAD = "CASE WHEN min({c}) < max({c}) THEN stddev_pop({c}) ELSE 1.0 END"
_HASHED = "(('0x' || substr(md5({salt} || '/' || k), 1, 8))::BIGINT / 2147483648.0::DOUBLE - 1.0)"


def _on_grid(c: str, salt: str) -> str:
    return f"CAST(round_even(({c} / s{c} + 1e-10 * greatest(1.0, a{c} / s{c}) * {_HASHED.format(salt=salt)}) * 70368744177664.0::DOUBLE, 0) AS BIGINT) AS {c}"


@query("mutual_information_neighbours", f"""
WITH long AS (SELECT p_partkey::VARCHAR AS k, p_retailprice * (1 + p_size % 7) / 10.0::DOUBLE AS y, unnest([0, 1, 2]) AS f, unnest([p_size::DOUBLE, length(p_name)::DOUBLE, p_retailprice]) AS x FROM part),
spread AS (SELECT f, count(*) AS n, {_SPREAD.format(c='x')} AS sx, {_SPREAD.format(c='y')} AS sy, avg(abs(x)) AS ax, avg(abs(y)) AS ay FROM long GROUP BY f),
points AS MATERIALIZED (SELECT f, k, {_on_grid('x', 'f')}, {_on_grid('y', "'y'")} FROM long JOIN spread USING (f)),
radius AS MATERIALIZED (SELECT a.f, a.k, a.x, a.y, greatest(min(greatest(abs(a.x - b.x), abs(a.y - b.y)), 3)[3], 1) AS r FROM points a JOIN points b ON a.f = b.f AND a.k <> b.k GROUP BY ALL),
near AS (SELECT a.f, a.k, count(*) FILTER (abs(a.x - b.x) < r) AS nx, count(*) FILTER (abs(a.y - b.y) < r) AS ny FROM radius a JOIN points b ON a.f = b.f AND a.k <> b.k GROUP BY ALL),
psi AS (SELECT i AS m, -0.5772156649015329 + coalesce(sum(1.0 / i) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p FROM (SELECT unnest(range(1, (SELECT max(n) + 2 FROM spread))) AS i)),
means AS (SELECT f, avg(a.p + b.p) AS s FROM near JOIN psi a ON a.m = nx + 1 JOIN psi b ON b.m = ny + 1 GROUP BY f)
SELECT ['size', 'name_length', 'retail'][f + 1] AS feature, round(greatest(0, (SELECT p FROM psi WHERE m = n) + (SELECT p FROM psi WHERE m = 3) - s), 6) + 0.0 AS score FROM means JOIN spread USING (f)""")
def mi_by_neighbours(spark, sf):
    """Information of three numbers about a part's price, by the three nearest rows of every row."""
    rows = table(spark, sf, "part").select(
        F.col("p_partkey").alias("sample_id"), (F.col("p_retailprice") * (1 + F.col("p_size") % 7) / 10.0).alias("price"),
        F.col("p_size").alias("size"), F.length("p_name").alias("name_length"), F.col("p_retailprice").alias("retail"))
    scores = neighbour_information(rows, _PART_FEATURES, "price")
    return scores.select("feature", (F.round("score", 6) + 0.0).alias("score"))


@query("importance_summary", f"""
WITH {_LONG}, {_f_sql('feature, fold')}
SELECT feature, round(avg(score), 4) AS mean_importance, round(stddev_samp(score), 4) AS std_importance FROM score GROUP BY feature""")
def importance_summary(spark, sf):
    """Feature scores of the three folds, averaged as importances of three models."""
    rows = add_fold(line_features(spark, sf), 3, "l_orderkey")
    parts = None
    for i in range(3):
        scores = f_regression(rows.where(F.col("fold") == i), FEATURES, "price")
        part = scores.select("feature", F.lit(f"fold {i}").alias("model"), F.col("score").alias("importance"))
        parts = part if parts is None else parts.unionByName(part)
    return rounded(aggregate_importance(parts), ["feature"], ["mean_importance", "std_importance"], 4)
