"""One query per operator over the driver's tables.

Lists and maps leave as joined strings, scores rounded, so that a result can be
compared value by value with plain SQL.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from passagerank.operators import errors, evaluate, expand, index, ltr, search, spelling, stance
from passagerank.operators.features import DEFAULT_FEATURES, attach_labels, features, filter_qrels, head_topics
from passagerank.operators.rerank import coverage, rerank, term_coverage
from passagerank.operators.scoring import BatchScorer
from passagerank.operators.trees import tree_table
from passagerank.operators.workspace import cut
from passagerank.plans.batch import bm25_batch
from passagerank.sources import readers, writers
from passagerank.testbed import DEPTH, SEED, Testbed

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Testbed(spark, sf_dir))
    return fn


def text_of(values: str | Column) -> Column:
    column = F.col(values) if isinstance(values, str) else values
    return F.array_join(column.cast("array<string>"), " ")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles cut to ``digits`` by the same arithmetic in every engine."""
    scale = F.lit(10.0**digits)

    def shortened(name: str) -> Column:
        return (F.floor(F.col(name) * scale + 0.5) / scale).alias(name)

    return df.select(*[
        shortened(f.name) if f.dataType.simpleString() == "double" else F.col(f.name) for f in df.schema.fields
    ])


def big(df: DataFrame) -> DataFrame:
    """Integers of any width as BIGINT."""
    return df.select(*[
        F.col(f.name).cast("bigint").alias(f.name) if f.dataType.simpleString() in ("int", "smallint") else F.col(f.name)
        for f in df.schema.fields
    ])


# ------------------------------------------------------------- sources, sinks


@query
def topics(t: Testbed) -> DataFrame:
    return readers.read_topics(t.spark, t.topics_file).select("qid", "query")


@query
def topics_clean(t: Testbed) -> DataFrame:
    return readers.read_topics(t.spark, t.topics_file, clean=True).select("qid", "query")


@query
def qrels(t: Testbed) -> DataFrame:
    return big(readers.read_qrels(t.spark, t.qrels_file).drop("seq"))


@query
def corpus_meta(t: Testbed) -> DataFrame:
    corpus = readers.read_corpus(t.spark, t.corpus_file, meta_lengths=readers.META_LENGTHS)
    return corpus.select("doc_id", "text", "meta_doc_id", F.md5("meta_text").alias("meta_md5"))


@query
def corpus_jsonl(t: Testbed) -> DataFrame:
    return readers.read_corpus_jsonl(t.spark, t.jsonl_file)


@query
def stances_labelled(t: Testbed) -> DataFrame:
    bodies, stances = readers.read_stances(t.spark, t.stance_folder, "train")
    pairs = stance.pair_bodies(stances, bodies)
    return big(pairs.select("headline", "body_id", "stance", "label", F.md5("article_body").alias("body_md5")))


@query
def run_trec_lines(t: Testbed) -> DataFrame:
    return t.run.select(writers.trec_line("bm25").alias("line"))


@query
def run_lines_csv(t: Testbed) -> DataFrame:
    run = t.tied_run
    return run.select(
        writers.reranked_line("csv", "MonoT5").alias("csv_line"),
        writers.reranked_line("tsv", "MonoT5").alias("tsv_line"),
        writers.reranked_line("tsv", "MonoT5", compat=True).alias("compat_line"),
    )


def _run_back(t: Testbed, name: str, write, read) -> DataFrame:
    """A run as it comes back from the file that a writer made of it."""
    path = t._files(name, write)
    return big(rounded(read(path).select("qid", "doc_id", "rank", "score"), 4))


@query
def run_trec_file(t: Testbed) -> DataFrame:
    return _run_back(
        t, "run.trec", lambda p: writers.write_run_trec(t.run, p, mode="overwrite"), lambda p: readers.read_run_trec(t.spark, p)
    )


@query
def run_plain_file(t: Testbed) -> DataFrame:
    return _run_back(
        t, "run.plain", lambda p: writers.write_run_plain(t.run, p, mode="overwrite"),
        lambda p: readers.read_run_plain(t.spark, p),
    )


@query
def run_csv_file(t: Testbed) -> DataFrame:
    return _run_back(
        t, "run.csv", lambda p: writers.write_run_reranked(t.tied_run, p, mode="overwrite"),
        lambda p: readers.read_run_trec(t.spark, p, ","),
    )


@query
def run_tsv_file(t: Testbed) -> DataFrame:
    return _run_back(
        t, "run.tsv", lambda p: writers.write_run_reranked(t.tied_run, p, mode="overwrite"),
        lambda p: readers.read_run_trec(t.spark, p, "\t"),
    )


@query
def run_ltr_file(t: Testbed) -> DataFrame:
    learned = t.tied_run.withColumn("prior_rank", F.col("rank"))
    return _run_back(
        t, "run.ltr", lambda p: writers.write_run_ltr(learned, p, mode="overwrite"), lambda p: readers.read_run_trec(t.spark, p)
    )


@query
def run_nb_file(t: Testbed) -> DataFrame:
    return _run_back(
        t, "run.nb", lambda p: writers.write_run_nb(t.tied_run, p, "csv", mode="overwrite"),
        lambda p: readers.read_run_plain(t.spark, p),
    )


@query
def run_nb_tab_file(t: Testbed) -> DataFrame:
    """The notebook's tab form, in which a space stands before the score."""
    def back(path: str) -> DataFrame:
        parts = F.split("value", "[\t ]+")
        row = [parts[i].cast(k).alias(n) for i, (n, k) in enumerate((("qid", "bigint"), ("doc_id", "bigint"), ("rank", "int"), ("score", "double")))]
        return t.spark.read.text(path).select(*row)

    return _run_back(t, "run.nbtab", lambda p: writers.write_run_nb(t.tied_run, p, "tsv", mode="overwrite"), back)


@query
def index_reopened(t: Testbed) -> DataFrame:
    """Term statistics of the stored index, opened once more instead of being built."""
    _ = t.index
    return index.open_or_build(t.corpus, f"{t.root}/index").term_stats.select("term", "df", "cf")


@query
def index_words(t: Testbed) -> DataFrame:
    return t.index.words


@query
def stances_competition(t: Testbed) -> DataFrame:
    bodies, stances = readers.read_stances(t.spark, t.stance_folder, "competition")
    pairs = stance.pair_bodies(stances, bodies)
    return big(pairs.select("headline", "body_id", "stance", "label", F.md5("article_body").alias("body_md5")))


@query
def stances_unlabelled(t: Testbed) -> DataFrame:
    bodies, stances = readers.read_stances_unlabelled(t.spark, t.stance_folder)
    return stance.pair_bodies(stances, bodies).select("headline", "body_id", F.md5("article_body").alias("body_md5"))


# ------------------------------------------------------------------- analysis


@query
def analyze(t: Testbed) -> DataFrame:
    out = index.analyze(t.corpus, "text", stemmer=None)
    return out.select("doc_id", text_of("tokens").alias("tokens"), F.size("tokens").cast("bigint").alias("n_tokens"))


@query
def analyze_stemmed(t: Testbed) -> DataFrame:
    """The default analyzer."""
    out = index.analyze(t.corpus, "text")
    return out.select("doc_id", text_of("tokens").alias("tokens"), F.size("tokens").cast("bigint").alias("n_tokens"))


@query
def token_positions(t: Testbed) -> DataFrame:
    return big(index.tokenize_flat(t.corpus, "text", stemmer=None))


@query
def stem_vocab(t: Testbed) -> DataFrame:
    vocabulary = index.tokenize_flat(t.corpus, "text", stemmer=None).select("term").distinct()
    return index.stem_vocabulary(vocabulary)


@query
def spell_correct(t: Testbed) -> DataFrame:
    fixed = spelling.spell_correct(t.typo_topics, t.index.words)
    return fixed.select("qid", "query", "corrected", "changed")


@query
def doc_top_terms(t: Testbed) -> DataFrame:
    return index.top_terms(t.index.docs, 10).select("doc_id", text_of("top_terms").alias("top_terms"))


# ---------------------------------------------------------------------- index


@query
def postings(t: Testbed) -> DataFrame:
    built = index.build_postings(t.corpus, stemmer=None)
    return big(built.select("term", "doc_id", "tf", text_of("positions").alias("positions")))


@query
def postings_stemmed(t: Testbed) -> DataFrame:
    """Postings of the index as it is built by default: words meet their stems in a dictionary."""
    rows = t.stemmed_index.postings.select("term", "doc_id", "tf", "dl", text_of("positions").alias("positions"))
    return big(rows)


@query
def doc_lengths(t: Testbed) -> DataFrame:
    return index.doc_lengths(t.index.postings)


@query
def term_counts(t: Testbed) -> DataFrame:
    return index.term_counts(t.index.postings)


@query
def collection_stats(t: Testbed) -> DataFrame:
    return rounded(index.collection_stats(t.index.doc_stats))


@query
def doc_vectors(t: Testbed) -> DataFrame:
    vectors = index.doc_vector(t.index.docs, t.run)
    entries = F.array_sort(F.transform(
        F.map_entries("vector"), lambda e: F.concat_ws(":", e["key"], e["value"].cast("string"))
    ))
    return vectors.select("doc_id", text_of(entries).alias("vector"))


@query
def fetch_docs(t: Testbed) -> DataFrame:
    return big(index.fetch_docs(t.run.select("qid", "doc_id", "rank"), t.index.docs))


# ------------------------------------------------------------------ retrieval


@query
def bm25_search(t: Testbed) -> DataFrame:
    return big(search.search(t.topics, t.index, k=1000))


@query
def bm25_scores(t: Testbed) -> DataFrame:
    return big(rounded(search.search_with_scores(t.topics, t.index, k=DEPTH), 4))


@query
def bm25_exact_length(t: Testbed) -> DataFrame:
    return big(rounded(search.search_with_scores(t.topics, t.index, k=DEPTH, length_norm="exact"), 4))


@query
def bm25_turns(t: Testbed) -> DataFrame:
    return big(rounded(search.search_with_scores(t.turns, t.index, k=DEPTH), 4))


@query
def bm25_stemmed(t: Testbed) -> DataFrame:
    return big(rounded(search.search_with_scores(t.topics, t.stemmed_index, k=DEPTH), 4))


@query
def bm25_top3(t: Testbed) -> DataFrame:
    found = search.search_one(t.spark, "the then thenly erha tion of this ouer", t.index, k=3)
    return big(rounded(found, 4))


@query
def rank_cutoff(t: Testbed) -> DataFrame:
    return big(rounded(search.rank_cutoff(t.run, 10), 4))


@query
def rerank_candidates(t: Testbed) -> DataFrame:
    hits = search.candidates_with_text(t.run, t.index.docs, t.topics, 100)
    return big(rounded(hits, 4))


@query
def ranking_arrays(t: Testbed) -> DataFrame:
    return search.ranking_arrays(t.run, DEPTH).withColumn("doc_ids", text_of("doc_ids"))


# ------------------------------------------------------------------ expansion


def _feedback(t: Testbed) -> DataFrame:
    return t._stored("feedback", lambda: expand.feedback_terms(t.run, t.index))


@query
def feedback_terms(t: Testbed) -> DataFrame:
    return expand.feedback_terms(t.run, t.index)


@query
def offer_weights(t: Testbed) -> DataFrame:
    return rounded(expand.offer_weights(_feedback(t), t.index, DEPTH))


@query
def expansion_terms(t: Testbed) -> DataFrame:
    return big(rounded(expand.best_feedback_terms(t.run, t.topics, t.index, 10, DEPTH)))


@query
def expansion_terms_of_all(t: Testbed) -> DataFrame:
    """The same terms, chosen after every feedback term was counted."""
    fresh = expand.drop_query_terms(_feedback(t), t.topics, t.index)
    best = expand.expansion_terms(expand.offer_weights(fresh, t.index, DEPTH), 10)
    return big(rounded(best))


def _expanded(t: Testbed) -> DataFrame:
    return expand.expand_queries(t.topics, t.index, 10, feedback_k=DEPTH).drop("seq")


@query
def expand_queries(t: Testbed) -> DataFrame:
    return _expanded(t)


@query
def expand_queries_stemmed(t: Testbed) -> DataFrame:
    return expand.expand_queries(t.topics, t.stemmed_index, 10, feedback_k=DEPTH).drop("seq")


@query
def bm25_expanded(t: Testbed) -> DataFrame:
    expanded = t._stored("expanded", lambda: _expanded(t))
    return big(rounded(search.search_with_scores(expanded, t.index, k=DEPTH), 4))


@query
def bm25_spelled(t: Testbed) -> DataFrame:
    """The batch with spelling on: topics with a letter missing are mended, then searched."""
    return big(rounded(bm25_batch(t.typo_topics.select("qid", "query"), t.index, k=DEPTH, spell_checking=True), 4))


# ------------------------------------------------------------ learning to rank


@query
def head_topics_(t: Testbed) -> DataFrame:
    return head_topics(t.topics, 15).select("qid", "query")


QUERIES["head_topics"] = QUERIES.pop("head_topics_")


@query
def filter_qrels_(t: Testbed) -> DataFrame:
    return big(filter_qrels(t.qrels, head_topics(t.topics, 15)))


QUERIES["filter_qrels"] = QUERIES.pop("filter_qrels_")


def _one_feature(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = Testbed(spark, sf_dir)
        rows = features(t.topics, t.index, (name,), k=DEPTH)
        return big(rounded(rows.select("qid", "doc_id", "rank", name), 4))

    QUERIES[name] = run


for _name in (*DEFAULT_FEATURES, "f_bm25"):
    _one_feature(_name)


@query
def ltr_features(t: Testbed) -> DataFrame:
    rows = features(t.topics, t.index, k=1000)
    return big(rounded(rows.drop("score"), 4))


@query
def ltr_training(t: Testbed) -> DataFrame:
    rows = attach_labels(features(t.topics, t.index, k=DEPTH), t.qrels)
    return big(rounded(rows.drop("score"), 4))


@query
def lambda_gradients(t: Testbed) -> DataFrame:
    rows = t.ltr_rows.select("qid", "doc_id", "label", "score")
    return rounded(ltr.lambda_gradients(rows, depth=DEPTH), 6)


#: The queries of this share (one in so many, by hash) are held out of training, for validation.
HELD_OUT = 5


def _trained(t: Testbed, name: str) -> ltr.RankModel:
    """The stored model of a session, trained when it is first asked for."""
    held_out = F.pmod(F.xxhash64("qid"), F.lit(HELD_OUT)) == 0
    learn, valid = t.ltr_rows.filter(~held_out), t.ltr_rows.filter(held_out)
    train = {
        "lambdamart": lambda: ltr.train_lambdamart(learn, valid, list(DEFAULT_FEATURES), rounds=100, num_leaves=7, depth=DEPTH),
        "randomforest": lambda: ltr.train_random_forest(learn, list(DEFAULT_FEATURES), n_trees=100),
    }[name]
    return ltr.load_model(t.spark, t._files(f"model-{name}", lambda path: ltr.save_model(train(), t.spark, path)))


@query
def boost_step(t: Testbed) -> DataFrame:
    """One boosting step with given splits: the leaf that each row comes to, by its new score."""
    splits = [(0, "f_tf", 2.5, 1, 2), (2, "f_tf", 5.5, 3, 4), (1, "f_sample", 4.000000123, 5, 6), (4, "f_pl2", 3.000000123, 7, 8)]
    model = ltr.fit_leaves(t.ltr_rows, list(DEFAULT_FEATURES), splits)
    return rounded(model.transform(t.ltr_rows, "score").select("qid", "doc_id", "score"))


@query
def given_trees(t: Testbed) -> DataFrame:
    """Scores of a model whose nodes are given, after it was stored and read back."""
    leaf = {"feature": -1, "threshold": float("inf"), "gain": 0.0}
    split = {"value": 0.0, "gain": 1.0}
    nodes = pd.concat([
        tree_table([
            {**split, "feature": 1, "threshold": 3.5, "left": 1, "right": 2},
            {**leaf, "left": 1, "right": 1, "value": 0.25},
            {**split, "feature": 0, "threshold": 6.000000123, "left": 3, "right": 4},
            {**leaf, "left": 3, "right": 3, "value": 0.5}, {**leaf, "left": 4, "right": 4, "value": 2.0},
        ], 0),
        tree_table([
            {**split, "feature": 1, "threshold": 1.5, "left": 1, "right": 2},
            {**leaf, "left": 1, "right": 1, "value": -1.0}, {**leaf, "left": 2, "right": 2, "value": 1.0},
        ], 1),
    ], ignore_index=True)
    model = ltr.RankModel("lambdamart", ["f_sample", "f_tf"], nodes, 0.5)
    path = f"{t.root}/models/given"
    ltr.save_model(model, t.spark, path)
    ranked = rerank(t.ltr_rows, ltr.load_model(t.spark, path), depth=DEPTH)
    return big(rounded(ranked.select("qid", "doc_id", "rank", "score")))


@query
def lambdamart_rank(t: Testbed) -> DataFrame:
    model = _trained(t, "lambdamart")
    return rerank(t.ltr_rows, model, depth=DEPTH).select("qid", "doc_id", "rank", "prior_rank", "score")


@query
def random_forest_rank(t: Testbed) -> DataFrame:
    model = _trained(t, "randomforest")
    return rerank(t.ltr_rows, model, depth=DEPTH).select("qid", "doc_id", "rank", "prior_rank", "score")


def _checked(t: Testbed, model: ltr.RankModel, name: str) -> DataFrame:
    """Per query, what must hold of any trained run; and what must hold of the model."""
    path = f"{t.root}/models/{name}"
    ltr.save_model(model, t.spark, path)
    ranked = cut(rerank(t.ltr_rows, model, depth=DEPTH))
    again = rerank(t.ltr_rows, ltr.load_model(t.spark, path), depth=DEPTH).select("qid", "doc_id", F.col("rank").alias("reloaded"))
    gained = ltr._ndcg(ranked, (10,), DEPTH)["ndcg_10"] >= ltr._ndcg(t.ltr_rows, (10,), DEPTH)["ndcg_10"]
    whole = abs(sum(model.feature_importance().values()) - 1) < 1e-6
    ahead = Window.partitionBy("qid").orderBy("rank")
    walked = ranked.join(again, ["qid", "doc_id"], "left").select(
        "*", F.lag("score").over(ahead).alias("__score"), F.lag("prior_rank").over(ahead).alias("__prior")
    )
    given = t.ltr_rows.groupBy("qid").agg(F.count(F.lit(1)).alias("given"))
    first = F.col("__score").isNull()
    per = walked.groupBy("qid").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("doc_id").alias("docs"),
        (F.count_distinct("rank") == F.max("rank") + 1).alias("dense_ranks"),
        F.bool_and(first | (F.col("__score") >= F.col("score"))).alias("by_score"),
        F.bool_and(first | (F.col("__score") != F.col("score")) | (F.col("__prior") < F.col("prior_rank"))).alias("stable_ties"),
        F.bool_and(F.col("reloaded").eqNullSafe(F.col("rank"))).alias("same_after_reload"),
    )
    same = (F.col("docs") == F.col("given")) & (F.col("n_rows") == F.col("given"))
    return per.join(given, "qid").select(
        "qid", "n_rows", same.alias("same_candidates"), "dense_ranks", "by_score", "stable_ties", F.lit(gained).alias("gains"),
        F.lit(whole).alias("importances_sum_to_one"), "same_after_reload",
    )


@query
def lambdamart_checked(t: Testbed) -> DataFrame:
    model = _trained(t, "lambdamart")
    return _checked(t, model, "lambdamart")


@query
def random_forest_checked(t: Testbed) -> DataFrame:
    model = _trained(t, "randomforest")
    return _checked(t, model, "randomforest")


@query
def rerank_coverage(t: Testbed) -> DataFrame:
    hits = search.candidates_with_terms(t.run, t.index, t.topics, DEPTH)
    ranked = rerank(hits, term_coverage(), depth=DEPTH)
    return big(rounded(ranked.select("qid", "doc_id", "rank", "prior_rank", "score")))


@query
def rerank_text_coverage(t: Testbed) -> DataFrame:
    """The usual hundred candidates with their texts, analyzed as they are scored."""
    hits = search.candidates_with_text(t.run, t.index.docs, t.topics, 100)
    ranked = rerank(hits, coverage(stemmer=None), depth=DEPTH)
    return big(rounded(ranked.select("qid", "doc_id", "rank", "prior_rank", "score")))


@query
def rerank_arrow(t: Testbed) -> DataFrame:
    """The hundred candidates of every topic, scored in Arrow batches by a model that is loaded once per worker."""
    def by_lengths():
        # stands for a model: scores that plain SQL can follow
        return lambda queries, texts: [(31 * len(t) + 17 * len(q)) % 1009 / 1009 for q, t in zip(queries, texts, strict=True)]

    hits = search.candidates_with_text(t.run, t.index.docs, t.topics, 100)
    scorer = BatchScorer(by_lengths, f"{t.root}/scored-by-length", slices=4)
    return big(rounded(rerank(hits, scorer, depth=DEPTH).select("qid", "doc_id", "rank", "prior_rank", "score")))


# ----------------------------------------------------------------- evaluation


@query
def rel_retrieved(t: Testbed) -> DataFrame:
    return big(errors.relevant_retrieved(t.qrels, t.run))


@query
def rel_not_retrieved(t: Testbed) -> DataFrame:
    return big(errors.relevant_not_retrieved(t.qrels, t.run))


@query
def nonrel_retrieved(t: Testbed) -> DataFrame:
    return big(errors.non_relevant_retrieved(t.qrels, t.run))


@query
def recall_count(t: Testbed) -> DataFrame:
    return errors.recall_count_at(t.qrels, t.run, 10)


@query
def worst_queries(t: Testbed) -> DataFrame:
    worst = errors.worst_queries(t.qrels, t.run, t.topics, t.index, n=5, pick=5, count=10)
    return worst.withColumn("tokens", text_of("tokens"))


@query
def rating_histogram(t: Testbed) -> DataFrame:
    return big(errors.rating_histogram(t.qrels, t.run))


@query
def annotated_ranking(t: Testbed) -> DataFrame:
    out = errors.annotate_ranking(t.run.drop("score"), t.qrels, t.index, depth=DEPTH)
    return big(out.withColumn("top_terms", text_of("top_terms")))


@query
def judged_per_query(t: Testbed) -> DataFrame:
    return rounded(errors.judged_per_query(t.qrels))


@query
def queries_containing(t: Testbed) -> DataFrame:
    return errors.queries_containing(t.qrels, t.topics, "tion of")


@query
def trec_order(t: Testbed) -> DataFrame:
    return big(rounded(evaluate.trec_order(t.tied_run, depth=DEPTH)))


def _judged(t: Testbed) -> evaluate.Judged:
    return evaluate.judge(t.run, t.qrels, depth=DEPTH)


@query
def eval_counts(t: Testbed) -> DataFrame:
    return evaluate.eval_counts(_judged(t))


@query
def eval_gm_map(t: Testbed) -> DataFrame:
    return rounded(evaluate.eval_gm_map(_judged(t)))


def _measure(name: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(getattr(evaluate, f"eval_{name}")(_judged(Testbed(spark, sf_dir))))

    QUERIES[f"eval_{name}"] = run


for _name in ("map", "rprec", "bpref", "recip_rank", "iprec", "precision", "recall", "ndcg"):
    _measure(_name)


@query
def eval_report(t: Testbed) -> DataFrame:
    return rounded(evaluate.report(_judged(t)))


@query
def experiment(t: Testbed) -> DataFrame:
    runs = {"bm25": t.run, "sample": t.ltr_rows, "overlap": t.tied_run}
    return rounded(evaluate.experiment(runs, t.qrels, ("map", "recip_rank", "ndcg"), t.topics, depth=DEPTH))


# --------------------------------------------------------------------- stance


@query
def stance_labels(t: Testbed) -> DataFrame:
    labelled = t.stances.withColumn("label", stance.stance_to_label(F.col("stance")))
    return big(labelled.select("row_id", "stance", "label"))


@query
def stance_pairs(t: Testbed) -> DataFrame:
    return stance.pair_bodies(t.stances, t.bodies, order=("body_id",)).select(
        "row_id", "headline", "body_id", "article_body"
    )


def _labelled(t: Testbed) -> DataFrame:
    return t.stances.withColumn("label", stance.stance_to_label(F.col("stance")))


@query
def stance_kfold(t: Testbed) -> DataFrame:
    return big(stance.kfold(t.stances, 10, SEED).select("row_id", "fold"))


@query
def fnc_score_rows(t: Testbed) -> DataFrame:
    score = stance.fnc_score(F.col("label"), F.col("predicted"))
    return _labelled(t).select("row_id", score.alias("score"))


@query
def fnc_score_folds(t: Testbed) -> DataFrame:
    folds = stance.kfold(_labelled(t), 10, SEED)
    return big(rounded(stance.evaluate_fold(folds, t.stances.select("row_id", "predicted"), by=("fold",))))


@query
def fnc_score_total(t: Testbed) -> DataFrame:
    return rounded(stance.evaluate_comp(_labelled(t), t.stances.select("row_id", "predicted")))


@query
def stance_random_baseline(t: Testbed) -> DataFrame:
    guesses = stance.random_baseline(t.stances, SEED)
    return big(guesses.select("row_id", "predicted"))
