import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import cloudpickle

import metricloom
from metricloom.session import local_session

cloudpickle.register_pickle_by_value(metricloom)


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=8, shuffle_partitions=4)


SMALL = "/root/testdata/sf0.001"
