"""The pricing stream entry point, file-source branch, end to end."""

import os

from conftest import SF001


def test_stream_cli_files_once(spark, tmp_root):
    from zonefare.streaming import store
    from zonefare.streaming.run import main
    root = os.path.join(tmp_root, "store")
    main(["--source", "files", "--path", SF001, "--glob", "events.parquet", "--root", root,
          "--checkpoint", os.path.join(tmp_root, "ckpt"), "--once"])
    assert store.read_history(spark, root).count() == 44
    assert store.read_current(spark, root).count() == 44
    assert store.read_dead_letters(spark, root).count() > 0
