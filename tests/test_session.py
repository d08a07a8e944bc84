from tidemark.session import shuffle_partitions


def test_shuffle_partitions():
    assert shuffle_partitions(0) == 8
    assert shuffle_partitions(128 * 1024**2 * 100 + 1) == 101
    assert shuffle_partitions(100 * 1024**4, at_least=4000) == 819_200
