"""Entity mentions and relations between them."""

from __future__ import annotations

from pyspark.sql import functions as F

from articlemill.functions.text import word_tokens
from articlemill.operators import entities as E
from articlemill.operators import relations as R
from articlemill.operators import relation_patterns, span_sets, tagger, term_trie
from articlemill.sources.saved import BUCKETS, save_by_key
from articlemill.sources.scratch import scratch_path, written
from articlemill.sources.tables import read_table, scan_parts, spread
from catalog.sql import WORD_RX, pattern_spans_sql, spans_sql, token_rows

TYPES = ["PERSON", "ORGANIZATION", "LOCATION"]
TERMS = 300
DENSE = "^[A-Za-z]{4,}$"
KEYS = ["doc_id"]


def documents(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", "text")


def gazetteer(spark, sf):
    docs = spread(documents(spark, sf), "doc_id")
    return E.frequent_gazetteer(docs, "text", TERMS, TYPES)


def dense_gazetteer(spark, sf):
    """Frequent words in any case, so that mentions have neighbours to merge and pair."""
    docs = spread(documents(spark, sf), "doc_id")
    return E.frequent_gazetteer(docs, "text", TERMS, TYPES, DENSE)


def token_tags(spark, sf):
    docs = spread(documents(spark, sf), "doc_id")
    return E.token_tags(docs, KEYS, "text", gazetteer(spark, sf), bound=TERMS)


def mentions(spark, sf):
    docs = documents(spark, sf)
    known = E.known_tokens(docs, KEYS, "text", dense_gazetteer(spark, sf), bound=TERMS)
    return E.merge_adjacent(known, KEYS)


def entity_merge_adjacent(spark, sf):
    return mentions(spark, sf)


def entity_spans(spark, sf):
    return E.entity_spans(documents(spark, sf), KEYS, "text")


def entity_text(spark, sf):
    spans = E.entity_spans(documents(spark, sf), KEYS, "text")
    return spans.select("doc_id", "type", "begin", F.col("text").alias("entity"))


def gazetteer_spans(spark, sf):
    return E.gazetteer_spans(
        documents(spark, sf), KEYS, "text", gazetteer(spark, sf), bound=TERMS
    )


def entities_by_type(spark, sf):
    return E.of_type(mentions(spark, sf), "LOCATION").select("doc_id", "text")


def entity_per_sentence(spark, sf):
    return E.entities_by_sentence(documents(spark, sf), KEYS, "text")


def entity_ensemble(spark, sf):
    """Three taggers: known names, then patterns of fixed form, then bare numbers."""
    docs = documents(spark, sf)
    patterns = E.entity_spans(docs, KEYS, "text").drop("prob")
    names = term_trie.term_spans(docs, KEYS, "text", gazetteer(spark, sf), bound=TERMS)
    tagger_rank = F.when(F.col("named"), 0).when(F.col("type") != "NUMBER", 1).otherwise(2)
    spans = names.withColumn("named", F.lit(True)).unionByName(patterns.withColumn("named", F.lit(False)))
    return E.combine_ranked(spans, KEYS, tagger_rank, 3).drop("named")


def phrases(spark, sf):
    """Terms of one to eight words, cut from the benchmark's items: each first word, and growing starts of each item."""
    words = read_table(spark, sf, "benchmark").select("item_id", word_tokens(F.col("text")).alias("w"))
    starts = words.select("item_id", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("n"), "w").filter(F.size("w") >= F.col("n"))
    kind = F.element_at(F.array(*[F.lit(t) for t in TYPES]), (F.col("n") % len(TYPES) + 1).cast("int"))
    return starts.select(F.array_join(F.slice("w", F.lit(1), F.col("n")), " ").alias("term"), kind.alias("type")).distinct()


def phrase_spans(spark, sf):
    """Where phrases of several words stand, the longest from the left."""
    return term_trie.term_spans(documents(spark, sf), KEYS, "text", phrases(spark, sf))


def entity_ensemble_heaviest(spark, sf):
    """Three taggers whose spans weigh their length times their probability; the heaviest set without overlap."""
    docs, length = documents(spark, sf), F.col("end") - F.col("begin")
    known = written(gazetteer(spark, sf), "gazetteer")
    model = fitted_tagger(spark, sf, known)
    taggers = [
        (E.entity_spans(docs, KEYS, "text"), length),
        (term_trie.term_spans(docs, KEYS, "text", known, bound=TERMS), length),
        (tagger.entities_with_probability(docs, KEYS, "text", model), length * F.col("prob")),
    ]
    return span_sets.combine_by_weight(taggers, KEYS)


def entity_compile(spark, sf):
    """Names from the gazetteer, times and amounts of money from patterns."""
    articles = read_table(spark, sf, "documents")
    patterns = E.entity_texts(documents(spark, sf), KEYS, "text", {k: E.ENTITY_PATTERNS[k] for k in ("TIME", "MONEY")})
    found = mentions(spark, sf).select("doc_id", "type", "text").unionByName(patterns)
    compiled = E.compiled_articles(articles, KEYS, "source", found)
    return E.compiled_json(compiled, KEYS)


def entity_gazetteer_match(spark, sf):
    places = read_table(spark, sf, "benchmark").select(F.explode(word_tokens(F.col("text"))).alias("name"))
    return E.matching_names(mentions(spark, sf), "LOCATION", places.distinct()).select(
        "doc_id", "first", "text"
    )


def person_alias_merge(spark, sf):
    return E.merge_aliases(mentions(spark, sf), KEYS)


def tagged_sentences(spark, sf):
    return tagger.tagged_sentences(documents(spark, sf), KEYS, "text", gazetteer(spark, sf), bound=TERMS)


def fitted_tagger(spark, sf, known):
    return tagger.fit_tagger(tagger.tagged_sentences(documents(spark, sf), KEYS, "text", known, bound=TERMS), KEYS)


def tag_transitions(spark, sf):
    return tagger.transition_counts(tagged_sentences(spark, sf), KEYS)


def tag_words(spark, sf):
    return tagger.emission_counts(tagger.word_counts(tagged_sentences(spark, sf)))


def token_tags_by_context(spark, sf):
    """Learns from what the gazetteer tags, then tags every token by its sentence."""
    model = fitted_tagger(spark, sf, written(gazetteer(spark, sf), "gazetteer"))
    return tagger.tags_by_context(documents(spark, sf), KEYS, "text", model)


def entity_probabilities(spark, sf):
    model = fitted_tagger(spark, sf, written(gazetteer(spark, sf), "gazetteer"))
    return tagger.entities_with_probability(documents(spark, sf), KEYS, "text", model)


def relation_pairs(spark, sf):
    """All pairs of mentions of a sentence, however far apart."""
    docs = documents(spark, sf)
    return R.relation_pairs(docs, KEYS, "text", dense_gazetteer(spark, sf), bound=TERMS, far=True)


def near_pairs(spark, sf):
    """The pairs near enough for a rule: all that can be related."""
    docs = documents(spark, sf)
    return R.relation_pairs(docs, KEYS, "text", dense_gazetteer(spark, sf), bound=TERMS)


def relations_filtered(spark, sf):
    return R.related(near_pairs(spark, sf))


def relation_strings(spark, sf):
    text = R.relation_text(F.col("left_text"), F.col("rel_type"), F.col("right_text"))
    return relations_filtered(spark, sf).select("doc_id", "sent_id", text.alias("relation"))


def saved_mentions(spark, sf):
    """Mentions by sentence, found once and saved by document."""
    docs = documents(spark, sf)
    found = R.sentence_mentions(docs, KEYS, "text", dense_gazetteer(spark, sf), R.most_between(R.RELATION_RULES), TERMS)
    path = scratch_path(spark, "mentions")
    return save_by_key(found, path.rsplit("/", 1)[1].replace("-", "_"), KEYS, path, max(BUCKETS, scan_parts(docs)))


def relations_of_saved_mentions(spark, sf):
    text = R.relation_text(F.col("left_text"), F.col("rel_type"), F.col("right_text"))
    pairs = R.related(R.pairs_of_mentions(saved_mentions(spark, sf), KEYS))
    return pairs.select("doc_id", "sent_id", text.alias("relation"))


def aliases_of_saved_mentions(spark, sf):
    return E.merge_aliases(saved_mentions(spark, sf), KEYS)


LEARNING_ROUNDS = 3


def learned_relations(spark, sf):
    """Learns from the pairs that the fixed rules type, over all pairs near each other."""
    pairs = written(near_pairs(spark, sf), "pairs")
    return relation_patterns.learn_relations(pairs, R.related(pairs), rounds=LEARNING_ROUNDS)


def relations_learned(spark, sf):
    return learned_relations(spark, sf).relations


def relation_patterns_learned(spark, sf):
    return learned_relations(spark, sf).patterns


QUERIES = {
    f.__name__: f
    for f in [
        token_tags, entity_merge_adjacent, entity_spans, entity_text, gazetteer_spans,
        entities_by_type, entity_per_sentence, entity_ensemble, entity_compile,
        entity_gazetteer_match, person_alias_merge, relation_pairs, relations_filtered,
        relation_strings, tag_transitions, tag_words, token_tags_by_context, entity_probabilities,
        phrase_spans, entity_ensemble_heaviest, relations_learned, relation_patterns_learned,
        relations_of_saved_mentions, aliases_of_saved_mentions,
    ]
}


def oracles() -> dict[str, str]:
    words = token_rows(f"regexp_extract_all(text, '{WORD_RX}')")
    def terms_sql(pattern):
        return f"""(SELECT token AS term,
          CASE length(token) % 3 WHEN 0 THEN '{TYPES[0]}' WHEN 1 THEN '{TYPES[1]}'
            ELSE '{TYPES[2]}' END AS type
        FROM ({words}) AS w WHERE regexp_matches(token, '{pattern}')
        GROUP BY token ORDER BY count(*) DESC, token LIMIT {TERMS})"""

    terms, dense = terms_sql(E.CAPITALISED), terms_sql(DENSE)

    def merged(rows, keys):
        """Mentions of tagged rows `(keys, pos, token, tag)`; tokens of one run in order."""
        return f"""SELECT {keys}, tag AS type, min(pos) AS first, max(pos) AS last,
              string_agg(token, ' ' ORDER BY pos) AS text
            FROM (SELECT *, pos - row_number() OVER (PARTITION BY {keys}, tag ORDER BY pos) AS run
                  FROM ({rows}) AS tagged) AS runs
            GROUP BY {keys}, tag, run"""

    def known(rows, keys):
        return f"""SELECT {keys}, pos, token, g.type AS tag FROM ({rows}) AS w
            JOIN {dense} AS g ON w.token = g.term"""

    mention = merged(known(words, "doc_id"), "doc_id")
    spans = pattern_spans_sql("documents", KEYS, "text", E.ENTITY_PATTERNS)
    sentences = spans_sql("documents", KEYS, "text", "[^.!?]+[.!?]*|[.!?]+", "sent_id")
    sentence_words = token_rows(
        f"regexp_extract_all(text, '{WORD_RX}')", f"({sentences})", "doc_id, sent_id"
    )
    rules = ", ".join(str(rule) for rule in R.RELATION_RULES)
    # Pairs from their definition: a mention, and any of its sentence that starts behind it.
    def paired(behind):
        return f"""WITH w AS MATERIALIZED ({sentence_words}),
        m AS MATERIALIZED ({merged(known("SELECT * FROM w", "doc_id, sent_id"), "doc_id, sent_id")}),
        q AS (SELECT l.doc_id, l.sent_id, l.text AS left_text, l.type AS left_type, r.text AS right_text,
            r.type AS right_type, l.first AS left_first, r.first AS right_first,
            (SELECT lower(coalesce(string_agg(w.token, ' ' ORDER BY w.pos), '')) FROM w
              WHERE w.doc_id = l.doc_id AND w.sent_id = l.sent_id AND w.pos > l.last AND w.pos < r.first) AS between
          FROM m AS l JOIN m AS r ON l.doc_id = r.doc_id AND l.sent_id = r.sent_id
            AND {behind})
        SELECT q.*, coalesce(r.rel_type, '_NR') AS rel_type
        FROM q LEFT JOIN (VALUES {rules}) AS r(left_type, between, right_type, rel_type)
          ON q.left_type = r.left_type AND q.between = r.between AND q.right_type = r.right_type"""

    # At most two tokens between, as far as a rule reaches.
    pairs = paired("r.first - l.last BETWEEN 1 AND 3")
    related = f"SELECT * FROM ({pairs}) AS found WHERE rel_type <> '_NR'"
    relation_strings = f"""SELECT doc_id, sent_id, left_text || ' ( ' || rel_type || ' ) ' || right_text AS relation
        FROM ({related}) AS r"""
    aliases = """{words}n AS (SELECT doc_id, text AS name, count(*) AS cnt,
          string_split(text, ' ')[-1] AS last_word, len(string_split(text, ' ')) AS n_words
        FROM ({mention}) AS m WHERE type = 'PERSON' GROUP BY doc_id, text)
        SELECT doc_id, name, cnt, CASE WHEN n_words > 1 THEN name ELSE
          first_value(name) OVER (PARTITION BY doc_id, last_word
            ORDER BY n_words DESC, length(name) DESC, name) END AS canonical FROM n"""

    def overlap(a, b):
        return f"""{a}.doc_id = {b}.doc_id AND {a}.begin < {b}."end" AND {b}.begin < {a}."end\""""

    lists = ", ".join(
        f"""coalesce(list(DISTINCT text ORDER BY text) FILTER (type = '{t}'), []) AS {t.lower()}"""
        for t in E.ENTITY_TYPES
    )
    gazetteer_sql = f"""SELECT doc_id, g.type, begin, "end", text
        FROM ({spans_sql('documents', KEYS, 'text', WORD_RX)}) AS s JOIN {terms} AS g ON s.text = g.term"""
    # Every token of every sentence with its gazetteer tag.
    tagged = f"""SELECT doc_id, sent_id, pos, token, coalesce(g.type, 'O') AS tag
        FROM ({sentence_words}) AS w LEFT JOIN {terms} AS g ON w.token = g.term"""
    form = "regexp_replace(token, '\\p{Lu}+', 'A', 'g')"
    for pattern, kind in (("[^\\p{N}\\P{L}A]+", "a"), ("\\p{N}+", "0"), ("[^Aa0]+", "-")):
        form = f"regexp_replace({form}, '{pattern}', '{kind}', 'g')"
    ending = "CASE WHEN length(token) > 4 AND regexp_matches(token, '^\\p{L}+$') THEN ' ' || lower(right(token, 2)) ELSE '' END"
    # Each round from its definition: patterns of what is known, then all pairs that occur in them.
    least, share = relation_patterns.SUPPORT, relation_patterns.CONFIDENCE
    learned = f"""WITH r AS MATERIALIZED ({pairs}),
        o AS MATERIALIZED (SELECT DISTINCT left_text, right_text, left_type, between, right_type FROM r),
        k0 AS MATERIALIZED (SELECT DISTINCT left_text, right_text, rel_type, CAST(1 AS DOUBLE) AS confidence FROM r WHERE rel_type <> '_NR')"""
    for i in range(LEARNING_ROUNDS):
        learned += f""",
        p{i} AS MATERIALIZED (SELECT left_type, between, right_type, rel_type, count(*) FILTER (hit) AS support,
            count(*) FILTER (hit) / count(*) AS confidence
          FROM (SELECT o.*, l.rel_type, EXISTS (SELECT 1 FROM k{i} AS k WHERE k.left_text = o.left_text AND k.right_text = o.right_text
              AND k.rel_type = l.rel_type) AS hit
            FROM o JOIN (SELECT DISTINCT left_text, rel_type FROM k{i}) AS l ON l.left_text = o.left_text) AS c
          GROUP BY ALL HAVING support >= {least} AND count(*) FILTER (hit) / count(*) >= {share}),
        k{i + 1} AS MATERIALIZED (SELECT left_text, right_text, rel_type, max(confidence) AS confidence FROM (SELECT * FROM k{i}
          UNION ALL SELECT left_text, right_text, rel_type, confidence FROM o JOIN p{i} USING (left_type, between, right_type)) AS u GROUP BY ALL)"""
    # Longest phrases at each place; from the first of a document on, the next that begins where one ends or later.
    phrase = f"""WITH RECURSIVE p AS (SELECT DISTINCT array_to_string(w[1:n], ' ') AS term,
          CASE n % 3 WHEN 0 THEN '{TYPES[0]}' WHEN 1 THEN '{TYPES[1]}' ELSE '{TYPES[2]}' END AS type
          FROM (SELECT regexp_extract_all(text, '{WORD_RX}') AS w FROM benchmark) AS b, range(1, 9) AS r(n) WHERE len(w) >= n),
        d AS (SELECT doc_id, regexp_extract_all(text, '{WORD_RX}') AS w FROM documents),
        g AS (SELECT doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') AS term
          FROM d, unnest(range(1, len(w) + 1)) AS t(s), range(1, 9) AS r(n) WHERE s + n - 1 <= len(w)),
        m AS MATERIALIZED (SELECT doc_id, s, max(n) AS n FROM g WHERE term IN (SELECT term FROM p) GROUP BY doc_id, s),
        x AS MATERIALIZED (SELECT a.doc_id, a.s, a.n, b.s AS next_s FROM m AS a ASOF LEFT JOIN m AS b ON a.doc_id = b.doc_id AND a.s + a.n <= b.s),
        f AS (SELECT doc_id, min(s) AS s FROM m GROUP BY doc_id UNION ALL
          SELECT x.doc_id, x.next_s FROM f JOIN x ON f.doc_id = x.doc_id AND f.s = x.s WHERE x.next_s IS NOT NULL),
        t AS MATERIALIZED ({spans_sql('documents', KEYS, 'text', WORD_RX)})
        SELECT f.doc_id, p.type, a.begin, b."end", substring(o.text, a.begin + 1, b."end" - a.begin) AS text
        FROM f JOIN m USING (doc_id, s) JOIN d USING (doc_id) JOIN documents AS o USING (doc_id)
          JOIN p ON p.term = array_to_string(w[s : s + n - 1], ' ')
          JOIN t AS a ON a.doc_id = f.doc_id AND a.pos = s - 1 JOIN t AS b ON b.doc_id = f.doc_id AND b.pos = s + n - 2"""
    return {
        "phrase_spans": phrase,
        "relations_learned": f"{learned} SELECT * FROM k{LEARNING_ROUNDS}",
        "relation_patterns_learned": f"{learned} SELECT * FROM p{LEARNING_ROUNDS - 1}",
        "tag_transitions": f"""WITH t AS (SELECT tag, lag(tag, 1, '|') OVER s AS before, lead(pos) OVER s IS NULL AS last
              FROM ({tagged}) AS t WINDOW s AS (PARTITION BY doc_id, sent_id ORDER BY pos))
            SELECT tag, next, count(*) AS n FROM (SELECT before AS tag, tag AS next FROM t
              UNION ALL SELECT tag, '|' FROM t WHERE last) AS steps GROUP BY ALL""",
        "tag_words": f"""WITH t AS MATERIALIZED (SELECT tag, token FROM ({tagged}) AS t),
            f AS (SELECT token FROM t GROUP BY token HAVING count(*) >= greatest(2, {tagger.WORD_SHARE} * (SELECT count(*) FROM t))),
            w AS MATERIALIZED (SELECT tag, CASE WHEN token IN (SELECT token FROM f) THEN token ELSE ' ' || {form} || {ending} END AS word FROM t),
            r AS (SELECT word FROM w GROUP BY word HAVING count(*) < {tagger.WORD_SHARE} * (SELECT count(*) FROM t))
            SELECT tag, CASE WHEN word IN (SELECT word FROM r) THEN ' ' ELSE word END AS word, count(*) AS n FROM w GROUP BY ALL""",
        "token_tags": f"""SELECT doc_id, pos, token, coalesce(g.type, 'O') AS tag
            FROM ({words}) AS w LEFT JOIN {terms} AS g ON w.token = g.term""",
        "entity_merge_adjacent": mention,
        "entity_spans": f"SELECT *, CAST(1.0 AS DOUBLE) AS prob FROM ({spans}) AS s",
        "entity_text": f"SELECT doc_id, type, begin, text AS entity FROM ({spans}) AS s",
        "gazetteer_spans": gazetteer_sql,
        "entities_by_type": f"SELECT doc_id, text FROM ({mention}) AS m WHERE type = 'LOCATION'",
        "entity_per_sentence": pattern_spans_sql(
            f"({sentences})", ["doc_id", "sent_id"], "text", E.ENTITY_PATTERNS
        ),
        "entity_ensemble": f"""WITH s AS MATERIALIZED ({spans}), a AS MATERIALIZED ({gazetteer_sql}),
            b AS (SELECT * FROM s WHERE type IN ('EMAIL', 'IP', 'TIME', 'MONEY')
              AND NOT EXISTS (SELECT 1 FROM a WHERE {overlap('a', 's')})),
            ab AS (SELECT * FROM a UNION ALL SELECT * FROM b)
            SELECT * FROM ab UNION ALL SELECT * FROM s WHERE type = 'NUMBER'
              AND NOT EXISTS (SELECT 1 FROM ab WHERE {overlap('ab', 's')})""",
        "entity_compile": f"""SELECT doc_id, CAST(to_json(struct_pack(title := source,
            {", ".join(f"{t.lower()} := coalesce({t.lower()}, [])" for t in E.ENTITY_TYPES)})) AS VARCHAR) AS json
            FROM documents LEFT JOIN (SELECT doc_id, {lists} FROM (
              SELECT doc_id, type, text FROM ({mention}) AS m UNION ALL
              SELECT doc_id, type, text FROM ({spans}) AS s WHERE type IN ('TIME', 'MONEY')) AS e
            GROUP BY doc_id) AS c USING (doc_id)""",
        "entity_gazetteer_match": f"""SELECT doc_id, first, text FROM ({mention}) AS m
            WHERE type = 'LOCATION' AND text IN
              (SELECT unnest(regexp_extract_all(text, '{WORD_RX}')) FROM benchmark)""",
        "person_alias_merge": aliases.format(mention=mention, words="WITH "),
        "relation_pairs": paired("r.first > l.last"),
        "relations_filtered": related,
        "relations_of_saved_mentions": relation_strings,
        "aliases_of_saved_mentions": aliases.format(mention=merged(known("SELECT * FROM w", "doc_id, sent_id"), "doc_id, sent_id"), words=f"WITH w AS MATERIALIZED ({sentence_words}), "),
        "relation_strings": relation_strings,
    }
