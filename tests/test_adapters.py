"""Row counts of the adapter views, known from an independent run of their SQL."""

from dosecast.operators import match
from dosecast.plans import forecast as job
from dosecast.workload import adapters as view


def test_counts(spark, sf):
    people, side = job.prepared_inputs(view.subjects(spark, sf), view.mapping(spark, sf), view.PARAMS)
    limit = view.PARAMS.broadcast_bytes
    found = (
        view.subjects(spark, sf).count(), view.mapping(spark, sf).count(), people.count(),
        match.match_specific(people, side, limit).count(), match.match_generic(people, side, limit).count(),
        match.match_tiered(people, side, limit).count(), match.unmatched_subjects(people, side, limit).count(),
    )
    assert found == (150, 2304, 136, 252, 756, 756, 10)
