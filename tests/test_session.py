"""Session defaults fill only unset keys; shuffle sizing follows input size."""

from __future__ import annotations

import logging

import pytest

from marquee.session import (
    SHUFFLE_TARGET_BYTES,
    apply_session_defaults,
    checkpoint_root,
    input_bytes,
    size_shuffles,
    warn_without_adaptive,
)

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)

    def set(self, key, value):
        self[key] = value


class _Session:
    """Launch-time settings (``launch``) and the runtime session conf."""

    def __init__(self, launch: dict[str, str], runtime: dict[str, str] | None = None):
        self._launch = launch
        self.conf = _Conf({**launch, **(runtime or {})})
        outer = self

        class _Context:
            def getConf(self):
                class _SparkConf:
                    def contains(self, key):
                        return key in outer._launch
                return _SparkConf()

        self.sparkContext = _Context()


def test_defaults_fill_only_unset_keys():
    s = _Session({"spark.sql.session.timeZone": "Europe/Paris"})
    apply_session_defaults(s, {"spark.sql.session.timeZone": "UTC", "spark.sql.adaptive.enabled": "true"})
    assert s.conf.get("spark.sql.session.timeZone") == "Europe/Paris"
    assert s.conf.get("spark.sql.adaptive.enabled") == "true"


def test_shuffle_sizing_from_input_size():
    s = _Session({}, {"spark.sql.shuffle.partitions": "200"})
    assert size_shuffles(s, 10 * 1024**3) == 200                      # small input: keep 200
    assert size_shuffles(s, 1024**4) == 1024**4 // SHUFFLE_TARGET_BYTES  # 1 TB -> 4096
    assert s.conf.get(INITIAL) == "4096"
    assert size_shuffles(s, 100 * 1024**4) == 100 * 1024**4 // SHUFFLE_TARGET_BYTES  # 100 TB: no cap
    assert size_shuffles(s, 1024**4, target_bytes=1024**3) == 1024


def test_shuffle_sizing_leaves_cluster_setting():
    s = _Session({"spark.sql.shuffle.partitions": "20000"})
    assert size_shuffles(s, 1024**5) is None and s.conf.get(INITIAL) is None


def test_no_local_scratch_on_a_cluster():
    class _Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return _Conf()

    session = _Session({})
    session.sparkContext = _Context()
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        session.sparkContext.master = master
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            checkpoint_root(session)


def test_input_bytes(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x" * 1000)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.tsv").write_text("y" * 24)
    assert input_bytes(spark, str(tmp_path)) == 1024


def test_warns_when_adaptive_execution_is_off(caplog):
    logger = logging.getLogger("marquee.test")
    with caplog.at_level(logging.WARNING, logger="marquee.test"):
        assert warn_without_adaptive(_Session({}, {"spark.sql.adaptive.enabled": "true"}), logger)
        assert not caplog.records
        assert not warn_without_adaptive(_Session({"spark.sql.adaptive.enabled": "false"}), logger)
    assert "hot partition values" in caplog.records[0].getMessage()
