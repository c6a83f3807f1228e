"""Scale properties of the plans, asserted on ``explain`` output: column pruning, pushed
filters, partial aggregation before the shuffle, one shuffle of the fact at most."""

from tests.conftest import SF001
from tristar.plans.inspect import (
    count_nodes, final_plan, plan_text, pushed_filters, read_schemas,
)
from tristar.plans.registry import QUERIES


def test_flagship_prunes_pushes_and_partially_aggregates(spark):
    df = QUERIES["verified_users_by_id"](spark, SF001)
    plan = plan_text(df)
    schemas = read_schemas(plan)
    assert "struct<l_partkey:bigint,l_suppkey:bigint>" in schemas      # 2 of 11 columns
    assert "struct<p_partkey:bigint>" in schemas                       # card keys only
    assert any("IsNotNull(l_partkey)" in f for f in pushed_filters(plan))
    assert "partial_count(1)" in plan
    # the fact crosses one exchange at most (the per-user partial counts)
    assert count_nodes(plan, "Exchange hashpartitioning") <= 2


def test_enriched_cards_reads_only_mapped_columns(spark):
    plan = plan_text(QUERIES["enriched_cards"](spark, SF001))
    assert "struct<l_partkey:bigint,l_suppkey:bigint,l_shipdate:timestamp_ntz>" in \
        read_schemas(plan)


def test_small_dimensions_broadcast_no_fact_shuffle(spark):
    df = QUERIES["enriched_cards"](spark, SF001)
    df.collect()
    plan = plan_text(df)
    assert "isFinalPlan=true" in plan
    plan = final_plan(plan)
    assert count_nodes(plan, "BroadcastHashJoin") == 2
    assert count_nodes(plan, "Exchange hashpartitioning") == 0


def test_changelog_scans_the_fact_once(spark):
    df = QUERIES["retract_changelog"](spark, SF001)
    plan = plan_text(df)
    # the source tables are read once, when the positioned rows are written; the plan
    # reads only that table, and its one window runs over block ids (the per-user prefix
    # of the small block aggregate), never over the rows in event order
    schemas = read_schemas(plan)
    assert schemas and all("__pos" in s for s in schemas)
    windows = [ln for ln in plan.splitlines() if "windowspecdefinition" in ln]
    assert windows and all("event_id" not in ln and "__b" in ln for ln in windows)


def test_latest_by_key_combines_map_side(spark):
    plan = plan_text(QUERIES["latest_by_key"](spark, SF001))
    assert "partial_max_by" in plan


def test_value_counts_sorts_only_the_aggregate(spark):
    plan = plan_text(QUERIES["value_counts"](spark, SF001))
    sort_line = [ln for ln in plan.splitlines() if "Exchange rangepartitioning" in ln]
    assert len(sort_line) == 1


def test_event_json_is_parsed_once(spark):
    plan = plan_text(QUERIES["events_verified_users"](spark, SF001))
    assert count_nodes(plan, "json_tuple(props") == 1
    assert "from_json" not in plan


def test_keyed_records_are_parsed_once(spark, tmp_path):
    from tests.conftest import SF0001
    from tristar.sources import event_star
    from tristar.streaming import keyed_star_streams, publish_star, stream_join
    paths = publish_star(event_star(spark, SF0001), str(tmp_path))
    plan = plan_text(stream_join(keyed_star_streams(spark, paths)))
    assert plan.count("from_json(") == 3        # one decode per stream, none in filters
