"""The stream commits changes of its state, and its settings are put back."""

import items as I
from goldweave import schema as S
from goldweave.plans.item_load import instant
from goldweave.sources import Store, publish
from goldweave.streaming import catchup
from test_streaming import windows_until, world

CHANGES = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"


def test_a_batch_commits_changes_of_the_state(spark, monkeypatch):
    folder, newest = world(spark, 2)
    store = Store(spark, f"{folder}/store")
    publish(I.frame(spark, [I.master_row(item_id="A")], S.MASTER_SCHEMA), store, "mst_item", "seed")
    before = {key: spark.conf.get(key, None) for key in catchup.STATE_SETTINGS}
    seen = []
    winners = catchup.winners

    def asked(*args, **options):
        seen.append(spark.conf.get(CHANGES))
        return winners(*args, **options)

    monkeypatch.setattr(catchup, "winners", asked)
    stream = spark.readStream.schema(S.MESSAGE_SCHEMA).parquet(f"{folder}/log")
    started = catchup.start_state_catch_up(
        stream, windows_until(newest), store, name="bom", checkpoint=f"{folder}/cp",
        run_ts=instant(I.RUN_TS), run_user=I.USER)
    started.stop()
    assert seen == ["true"]
    assert {key: spark.conf.get(key, None) for key in catchup.STATE_SETTINGS} == before
