"""The shared folder: only a local master may do without the setting."""

import pytest

from freshet.session import require_local


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[4,2]"])
def test_local_masters(master):
    require_local(master)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[3,2,3000]"])
def test_cluster_masters_need_the_setting(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir is not set"):
        require_local(master)
