import pytest

from inkmill.operators import audit
from inkmill.plans import fixtures
from tests.compare import SF


def joined(plan):
    """Names and types of what the joins of a plan hand on."""
    at = lambda seq: (seq.apply(i) for i in range(seq.size()))
    own = [(a.name(), a.dataType().simpleString()) for a in at(plan.output())] if plan.nodeName() == "Join" else []
    return own + [x for child in at(plan.children()) for x in joined(child)]


@pytest.mark.parametrize("of", [fixtures.prior, fixtures.fresh, lambda s, d: fixtures.fresh(s, d, True), fixtures.planned, lambda s, d: fixtures.archive_digests(s, d, fixtures.prior(s, d))])
def test_no_text_is_shuffled_for_its_digest(spark, of):
    out = joined(of(spark, SF)._jdf.queryExecution().optimizedPlan())
    assert out and all(name != "text" and "text:" not in kind for name, kind in out)


def test_a_swap_is_computed_once(spark):
    m, archive = fixtures.fresh(spark, SF, True), fixtures.fresh_archive(spark, SF, True)
    records, texts = audit.swapped(m, fixtures.later_archive(spark, SF), audit.repaired(m, archive))
    for out, most in ((records, {"manifest_pos"}), (texts, {"raw", "text"})):
        names = {n for n, _ in joined(out._jdf.queryExecution().optimizedPlan())}
        assert most <= names and not names & {"_old", "_new", "_holders"}
