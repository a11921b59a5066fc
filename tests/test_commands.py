"""The stages as commands, from source files to a search, on one small folder."""

import os

from inkmill.__main__ import main
from inkmill.sources import log
from tests.test_sources import _zip, by_key, put


def test_from_sources_to_a_search(spark, tmp_path, capsys):
    chapter = "<p>" + "A sentence about a silver plan for the long campaign. " * 12 + "{}</p>"
    put(tmp_path, src__a__book_DOT_epub=_zip({"1.html": chapter.format("one")}), src__book_DOT_mobi="same", src__two_DOT_epub=_zip({"1.html": chapter.format("zebra")}), src__bad_DOT_epub="broken", src__note_DOT_txt="x")
    put(tmp_path, src__two_DOT_mobi="twin")
    src, out = str(tmp_path / "src"), str(tmp_path / "lib")
    os.makedirs(out)

    def run(*args):
        code = main([*args, "--out", out], spark)
        last = capsys.readouterr().out.strip().split("\n")
        return code, dict(x.split("=") for x in last[-1].split(" ")), "\n".join(last)

    code, counts, _ = run("extract", "--src", src)
    assert code == 1 and (counts["n_new"], counts["n_failed"], counts["n_sources"]) == ("6", "1", "6")
    kinds = {k: r.quality for k, r in by_key(log.read(spark, out), "rel").items()}
    assert kinds == {"a/book.epub": "text", "book.mobi": "unsupported", "two.epub": "text", "bad.epub": "failed", "note.txt": "unsupported", "two.mobi": "skip_duplicate"}
    os.unlink(f"{src}/bad.epub")
    code, counts, _ = run("extract", "--src", src)
    assert (counts["n_kept"], counts["n_retried"]) == ("2", "2")
    assert run("build")[0] == 0 and run("build")[1] == {"n_documents": "2"}
    code, counts, _ = run("verify")
    assert (counts["ok"], counts["built"], counts["n_missing"], counts["healthy"]) == ("2", "True", "0", "True")
    assert run("search", "zebra")[1] == {"n_hits": "1"}
    assert run("index")[1] == {"generation": "1", "n_documents": "2"} and run("search", "zebra", "campaign")[1] == {"n_hits": "2"}
    assert run("cleanup", "--src", src)[1]["applied"] == "False" and os.path.exists(f"{src}/two.epub")
    code, counts, _ = run("cleanup", "--src", src, "--apply")
    assert code == 0 and counts["deleted_true" if "deleted_true" in counts else "deleted_True"] == "3"
    assert sorted(os.listdir(src)) == ["a", "book.mobi", "note.txt"] and os.listdir(f"{src}/a") == []
    assert run("compact")[1]["base"] == "3" and run("fix")[0] == 0
    assert sum(bool(r.original_deleted) for r in log.read(spark, out).collect()) == 3
