"""Queries over the driver's tables, one for each group of operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.functions import han, names, rules, text
from inkmill.operators import audit, changes, grams, incremental, keyrules, library, ocr, recovery, search
from inkmill.plans import fixtures as fx
from inkmill.sources.shared import cut, file_system, shared_dir

#: Prefixes that make safe and unsafe paths of a relative one, in turn by doc_id.
PREFIXES = ["", "/", "C:\\", "../", "a//", "a/./", "a/../", "\\\\s\\", "//s/", "n\\c\\", "..", "."]


def clean_text(s: SparkSession, d: str) -> DataFrame:
    docs = fx.documents(s, d)
    dirty = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("\x01\r\x0b\ufffd"), F.col("text"))).otherwise(F.col("text"))
    return docs.select("doc_id", text.clean(dirty).alias("text"), text.chars(text.clean(dirty)).alias("chars"), text.ocr_chars(text.clean(dirty)).alias("ocr_chars"))


def type_histogram(s, d):
    return fx.files(s, d).groupBy("ext").agg(F.count("*").alias("n"))


def quality_judge(s, d):
    return fx.files(s, d).select("doc_id", "units", rules.judge_by_ext(F.col("ext"), F.col("chars"), F.col("units")).alias("quality"))


def classify_docs(s, d):
    return fx.files(s, d).select("doc_id", "name", rules.classify(F.col("name")).alias("category"))


def subcategory_docs(s, d):
    cat = rules.classify(F.col("name"))
    return fx.files(s, d).select("doc_id", rules.location(cat, rules.subcategory(F.col("name"), cat)).alias("loc"))


def quality_by_category(s, d):
    f = fx.fresh(s, d)
    return f.groupBy("quality", "category").agg(F.count("*").alias("n"))


def html_to_text(s, d):
    return fx.table(s, d, "pages").select("page_id", text.page_text(F.col("html")).alias("text"))


def excerpt(s, d):
    return fx.documents(s, d).select("doc_id", text.excerpt(F.col("text")).alias("excerpt"))


def _han(s, d):
    return fx.documents(s, d).select("doc_id", fx.han_text(F.col("text")).alias("h"))


def han_keywords(s, d):
    return _han(s, d).select("doc_id", F.array_join(han.keywords(F.col("h")), " ").alias("keywords"))


def garble_score(s, d):
    h = F.col("h")
    return _han(s, d).select("doc_id", han.han_count(h).alias("n_han"), F.round(han.radical_rate(h), 9).alias("radicals"), F.round(han.repeat_rate(h), 9).alias("repeats"))


def garble_flagged(s, d):
    return _han(s, d).filter(han.garbled(F.col("h"))).select("doc_id")


def garble_repaired(s, d):
    fixed = han.repair(F.col("h"))
    return _han(s, d).select("doc_id", (fixed != F.col("h")).alias("changed"), text.text_sha256(fixed).alias("sha256"))


def radical_norm(s, d):
    return _han(s, d).select("doc_id", text.text_sha256(han.fold_radicals(F.col("h"))).alias("sha256"))


def _library(s, d, han: bool = False, ordered: bool = False):
    return library.documents(fx.fresh(s, d, han), fx.fresh_archive(s, d, han), ordered=ordered)


def front_matter(s, d):
    return library.markdown(_library(s, d, True))


def size_label(s, d):
    return fx.table(s, d, "documents").select("doc_id", text.size_label(F.col("n_chars") * 10).alias("label"))


def raw_names(s, d):
    return fx.files(s, d).select("doc_id", names.raw_name(F.col("rel")).alias("raw"), names.flat(F.col("rel")).alias("flat"))


def md_names(s, d):
    old = F.when(F.col("doc_id") % 10 != 9, F.col("rel"))
    return fx.files(s, d).select("doc_id", names.md_name(old, F.col("name")).alias("md"), names.key(old, F.col("name")).alias("key"))


def path_validity(s, d):
    prefix = F.element_at(F.array(*map(F.lit, PREFIXES)), (F.col("doc_id") % len(PREFIXES) + 1).cast("int"))
    return fx.files(s, d).select("doc_id", names.safe(F.concat(prefix, F.lit("d/"), F.col("name"))).alias("safe"))


def text_fingerprints(s, d):
    return fx.documents(s, d).select("doc_id", text.text_sha256(F.col("text")).alias("sha256"))


def mobi_epub_dedup(s, d):
    return incremental.with_books(fx.listing(s, d)).filter("duplicate_of is not null").select("rel", "duplicate_of")


def incremental_plan(s, d):
    return fx.planned(s, d).select("rel", "action", "counter", "refresh_raw", "duplicate_of")


def incremental_counts(s, d):
    return incremental.counts(fx.planned(s, d))


def merged_manifest(s, d):
    return fx.manifest(s, d)


def catalog(s, d):
    return library.catalogue(_library(s, d, True, ordered=True)).select("line", "manifest_pos")


def index_counts(s, d):
    return library.categories(fx.fresh(s, d)).select("category", "sub", "n", "ocr_n")


def quality_report(s, d):
    shares = library.usable_share(fx.fresh(s, d))
    return library.quality_counts(fx.fresh(s, d)).crossJoin(F.broadcast(shares.withColumnsRenamed({"n": "total"}))).drop("first")  # one row


def report_sections(s, d):
    return library.trouble(fx.fresh(s, d))


def _search(s, d, words, category=None):
    return search.search(search.searchable(_library(s, d)), words, category)


def search_topk(s, d):
    return search.top(_search(s, d, ["que", "der"])).select("path", "score", "why", "quality")


def search_context(s, d):
    return _search(s, d, ["the"]).select("path", "score", "context")


def search_category(s, d):
    return _search(s, d, ["the", "方案"], "营销策划").select("path", "score", "why")


def search_nothing(s, d):
    return _search(s, d, ["zzzznotfound"]).select("path", "score")


def search_indexed(s, d):
    """As ``search_topk``, by an index of pairs of characters that is built in two generations."""
    corpus = cut(search.searchable(_library(s, d)), "corpus")
    root = f"{shared_dir(s)}/index-{uuid.uuid4().hex}"
    fs, where = file_system(s, root)
    fs.deleteOnExit(where)
    grams.add(corpus.withColumn("body", F.when(F.crc32("path") % 3 == 0, "der alte Text").otherwise(F.col("body"))), root)
    grams.add(corpus.filter(F.crc32("path") % 3 == 0), root)
    return search.top(grams.find(corpus, root, ["que", "der"])).select("path", "score", "why", "quality")


def classify_table(s, d):
    """Benchmark items by a table of rules made of the long words of all documents."""
    return keyrules.classify(fx.table(s, d, "benchmark").select("item_id", "text"), fx.word_rules(s, d), "text", rules.OTHER).select("item_id", "category")


def verify_status(s, d):
    return audit.archive_status(fx.fresh(s, d, True), fx.fresh_archive(s, d, True))


def verify_counts(s, d):
    return audit.verified(fx.fresh(s, d, True), fx.fresh_archive(s, d, True))[1]


def garble_repair_records(s, d):
    fixed = audit.repaired(fx.fresh(s, d, True), fx.fresh_archive(s, d, True))
    return fixed.select("manifest_pos", "chars", "raw_sha256", "garble_fixed")


def missing_md(s, d):
    return audit.missing(fx.fresh(s, d), fx.library_paths(s, d)).select("path")


def orphan_md(s, d):
    return audit.orphans(fx.fresh(s, d), fx.library_paths(s, d))


def library_consistency(s, d):
    return audit.consistency(fx.fresh(s, d), fx.library_paths(s, d))


def at_stake(s, d):
    return audit.at_stake(fx.fresh(s, d))


def search_notes(s, d):
    """A word of the note of recognised documents."""
    return _search(s, d, ["ocr"]).select("path", "score", "context")


def cleanup_plan(s, d):
    return audit.removal_plan(fx.fresh(s, d), fx.listing(s, d), fx.fresh_archive(s, d)).select("manifest_pos", "decision", "size")


def cleanup_bytes(s, d):
    return audit.removal_bytes(audit.removal_plan(fx.fresh(s, d), fx.listing(s, d), fx.fresh_archive(s, d)))


def ocr_sample_pages(s, d):
    pages = ocr.sample_pages(F.col("units"))
    return fx.files(s, d).select("doc_id", F.array_join(pages.cast("array<string>"), " ").alias("pages"))


def ocr_book_judge(s, d):
    """Conversations stand for scanned files, their turns for sampled pages."""
    out = ocr.books(fx.table(s, d, "conversations"), "conv_id")
    return out.select("conv_id", F.round("mean", 6).alias("mean"), "is_book")


def ocr_applied(s, d):
    m = fx.fresh(s, d)
    return recovery.recognised(m, fx.recognised(s, d), ocr.candidates(m))


def conversion_candidates(s, d):
    return recovery.conversion_candidates(fx.fresh(s, d)).select("manifest_pos", "rel")


def conversion_applied(s, d):
    return recovery.converted(fx.fresh(s, d), fx.converted(s, d))


def run_counts(s, d):
    return incremental.counted(fx.planned(s, d), fx.extracted(s, d))[1]


def manifest_log(s, d):
    before = cut(fx.prior(s, d), "prior")
    return changes.fold(before, fx.change_log(s, d, before))


def garble_applied(s, d):
    """Records and texts after a repair is committed, though some texts were changed after they had been read for it."""
    m = cut(fx.fresh(s, d, True), "fresh")
    fixed = audit.repaired(m, fx.fresh_archive(s, d, True))
    records, texts = audit.swapped(m, fx.later_archive(s, d), fixed)
    held = texts.select("raw", text.text_sha256(F.col("text")).alias("archive_sha256"))
    return records.join(held, "raw", "left").select("manifest_pos", "chars", "raw_sha256", "garble_fixed", "archive_sha256")


def removal_recovered(s, d):
    return audit.recovered(fx.fresh(s, d), *fx.half_removed(s, d)).select("manifest_pos", "original_deleted")


_NAMES = (
    "clean_text type_histogram quality_judge classify_docs subcategory_docs quality_by_category html_to_text excerpt han_keywords garble_score garble_flagged "
    "garble_repaired radical_norm front_matter size_label raw_names md_names path_validity text_fingerprints mobi_epub_dedup incremental_plan incremental_counts "
    "merged_manifest catalog index_counts quality_report report_sections search_topk search_context search_category search_nothing verify_status verify_counts "
    "garble_repair_records missing_md orphan_md cleanup_plan cleanup_bytes ocr_sample_pages ocr_book_judge ocr_applied conversion_candidates "
    "conversion_applied run_counts library_consistency at_stake search_notes manifest_log garble_applied removal_recovered search_indexed classify_table"
).split()
QUERIES = {n: globals()[n] for n in _NAMES}
