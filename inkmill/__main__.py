"""Stages as commands: ``python -m inkmill COMMAND``; each is a few operators over the manifest's log and the archive at ``--out``."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmill.operators import audit, changes, grams, incremental, library, ocr, recovery, search
from inkmill.sources import archive, builder, files, log, manifests, removal, repair, tools
from inkmill.sources.shared import cut


def _archived(spark: SparkSession, manifest: DataFrame, root: str) -> DataFrame:
    return archive.read(manifest, root).filter("error is null").select("raw", "text")


def _commit(spark: SparkSession, before: DataFrame, after: DataFrame, done: DataFrame, root: str, writer: str) -> DataFrame:
    """Write texts (raw, text), then commit the manifest; texts that could not be written, whose records get no fingerprint."""
    wrote = cut(archive.write(done, root), "archived")
    lost = wrote.filter("error is not null").select("raw", F.lit(True).alias("_lost"))
    safe = after.join(lost, "raw", "left").withColumn("raw_sha256", F.when(F.col("_lost").isNull(), F.col("raw_sha256"))).select(*after.columns)
    log.append(changes.between(before, safe), root, writer)
    return wrote.filter("error is not null")


def extract(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Find sources, extract what is new or changed, merge it into the manifest."""
    found = files.listing(files.scan(spark, a.src, a.out), a.src)
    before = cut(log.read(spark, a.out), "before")
    digests = incremental.digests(_archived(spark, before, a.out))
    planned = cut(incremental.plan(found, before, digests, a.force), "planned")
    done = cut(files.extract(planned.filter("action = 'extract'"), a.src), "extracted")
    after = cut(incremental.merge(planned, before, done), "after")
    lost = _commit(spark, before, after, recovery.archived_texts(done), a.out, "extract")
    counts = incremental.counted(planned, done)[1].first().asDict()
    return {**counts, "n_not_written": lost.count()}


def books(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Recognise scanned books."""
    before = cut(log.read(spark, a.out), "before")
    candidates = ocr.candidates(before)
    from inkmill.sources import contained

    done = cut(ocr.recognise(candidates.select("rel"), lambda rel: contained.read(a.src, rel), tools.scanned_pages, tools.tesseract_page()), "recognised")
    lost = _commit(spark, before, recovery.recognised(before, done, candidates), recovery.archived_texts(done), a.out, "ocr")
    return {"n_tried": candidates.count(), "n_read": done.filter("error is null and text is not null").count(), "n_failed": done.filter("error is not null").count(), "n_not_written": lost.count()}


def convert(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Convert old slides and extract them."""
    before = cut(log.read(spark, a.out), "before")
    waiting = recovery.conversion_candidates(before).select("rel")
    done = cut(files.extract(waiting, a.src, {".ppt": files.ppt}), "converted")
    lost = _commit(spark, before, recovery.converted(before, done), recovery.archived_texts(done), a.out, "convert")
    return {"n_tried": waiting.count(), "n_failed": done.filter("error is not null").count(), "n_not_written": lost.count()}


def fix(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Repair garbled texts."""
    done = repair.apply(spark, a.out, a.radicals, a.repeats)
    return done.agg(*(F.count_if(F.col("state") == x).alias(f"n_{x}") for x in ("done", "conflict"))).first().asDict()


def build(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Rebuild the library's files."""
    manifest = cut(log.read(spark, a.out), "manifest")
    extra = open(a.index_extra, encoding="utf-8").read() if a.index_extra else ""
    return {"n_documents": builder.rebuild(manifest, _archived(spark, manifest, a.out), a.out, a.keep_image, extra).count()}


def verify(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Check the archive against the manifest, and the library against both."""
    manifest = cut(log.read(spark, a.out), "manifest")
    status, counts = audit.verified(manifest, _archived(spark, manifest, a.out))
    status.filter("status <> 'ok' or short_book").orderBy("manifest_pos").show(a.shown, truncate=False)
    paths = search.library_files(spark, a.out).select("path")
    return {**counts.first().asDict(), **audit.consistency(manifest, paths).first().asDict(), **audit.at_stake(manifest).first().asDict()}


def cleanup(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Show what of the sources may go; with --apply, remove it."""
    recovered = removal.recover(spark, a.out, a.src)
    manifest = cut(log.read(spark, a.out), "manifest")
    found = files.listing(files.scan(spark, a.src, a.out), a.src)
    plan = cut(audit.removal_plan(manifest, found, _archived(spark, manifest, a.out), a.delete_image), "plan")
    audit.removal_bytes(plan).show(truncate=False)
    if not a.apply:
        return {"n_recovered": recovered, "applied": False}
    done = removal.remove(spark, a.out, plan, a.src)
    return {"n_recovered": recovered, "applied": True, **{f"deleted_{r['deleted']}": r["count"] for r in done.groupBy("deleted").count().collect()}}


def find(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Search the library's files, or its index if ``index`` has made one."""
    corpus = search.library_files(spark, a.out)
    at = f"{a.out}/{INDEXED}"
    hits = grams.find(corpus, at, a.words, a.category) if grams.generations(spark, at) else search.search(corpus, a.words, a.category)
    search.top(hits, a.top).show(a.top, truncate=False)
    return {"n_hits": hits.count()}


INDEXED = ".index"


def index(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Index the library's files for ``search``; a further run indexes them anew."""
    corpus = cut(search.library_files(spark, a.out), "corpus")
    return {"generation": grams.add(corpus, f"{a.out}/{INDEXED}"), "n_documents": corpus.count()}


def compact(spark: SparkSession, a: argparse.Namespace) -> dict:
    """Fold the manifest's log into a base; with --json, also write the manifest as a table of that name."""
    number = log.compact(spark, a.out)
    return {"base": number, **({"version": manifests.commit(log.read(spark, a.out), a.json)} if a.json else {})}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="inkmill", description=__doc__)
    sub = out.add_subparsers(dest="command", required=True)

    def command(name: str, run, source: bool = False) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=run.__doc__.split("\n")[0])
        p.set_defaults(run=run)
        p.add_argument("--out", required=True, help="the library's folder, which driver and workers share")
        if source:
            p.add_argument("--src", required=True, help="the sources' folder")
        return p

    command("extract", extract, True).add_argument("--force", action="store_true", help="extract all sources anew")
    command("ocr", books, True)
    command("convert", convert, True)
    p = command("fix", fix)
    p.add_argument("--radicals", type=float, default=0.03)
    p.add_argument("--repeats", type=float, default=0.06)
    p = command("build", build)
    p.add_argument("--keep-image", action="store_true")
    p.add_argument("--index-extra")
    command("verify", verify).add_argument("--shown", type=int, default=20)
    p = command("cleanup", cleanup, True)
    p.add_argument("--apply", action="store_true")
    p.add_argument("--delete-image", action="store_true")
    p = command("search", find)
    p.add_argument("words", nargs="+")
    p.add_argument("--category")
    p.add_argument("--top", type=int, default=10)
    command("index", index)
    command("compact", compact).add_argument("--json")
    return out


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Run a command and print its counters; 1 if anything failed."""
    a = parser().parse_args(args)
    counts = a.run(spark or SparkSession.builder.appName("inkmill").getOrCreate(), a)
    print(" ".join(f"{k}={v}" for k, v in counts.items()))
    bad = sum(v or 0 for k, v in counts.items() if k in ("n_failed", "n_not_written", "n_conflict", "deleted_False", "n_missing", "n_orphans"))
    return int(bool(bad) or counts.get("healthy") is False)


if __name__ == "__main__":
    sys.exit(main())
