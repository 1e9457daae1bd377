"""An index client that fails on one block, for tests/test_upsert.py."""

from corpusflow.sources.upsert import FolderIndex


class Failing(FolderIndex):
    def stage(self, block, table):
        if block == "3":
            raise OSError("the index is down")
        return super().stage(block, table)


def make(options):
    return Failing(options)
