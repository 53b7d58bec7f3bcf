"""The checkpoint folder: the session's own, a scratch folder in local mode, an error on a cluster without one."""

from types import SimpleNamespace

import pytest

from bayesmill.session import ensure_checkpoint_dir


def _session(master, configured=None):
    named = []
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: named[-1] if named else None, setCheckpointDir=named.append,
                         getConf=lambda: SimpleNamespace(get=lambda key, default=None: configured))
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default=None: configured))


def test_checkpoint_dir():
    assert ensure_checkpoint_dir(_session("spark://host:7077", "/shared/x")) == "/shared/x"
    assert ensure_checkpoint_dir(_session("local[2]")).startswith("/tmp/run-")
    with pytest.raises(ValueError, match="shared folder"):
        ensure_checkpoint_dir(_session("spark://host:7077"))
