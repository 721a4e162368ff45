"""Clients of the delivery tests: they fail for some messages, or for a task's first attempts."""

from pyspark import TaskContext

from memberfold.sinks.clients import FolderClient


class Picky(FolderClient):
    """Refuses keys that end in 7, and tells so only when flushed."""

    def __init__(self, settings):
        super().__init__(settings)
        self.late = []

    def send(self, topic, key, value, done):
        if key is not None and key.endswith("7"):
            self.late.append(done)
        else:
            super().send(topic, key, value, done)

    def flush(self):
        for done in self.late:
            done(TimeoutError("no answer"))
        self.late = []
        super().flush()


class Stumbling(Picky):
    """Fails in the middle of each task's first ``fails`` attempts."""

    def __init__(self, settings):
        super().__init__(settings)
        self.left = 5 if TaskContext.get().attemptNumber() < int(settings["fails"]) else None

    def send(self, topic, key, value, done):
        if self.left is not None:
            self.left -= 1
            if self.left < 0:
                raise ConnectionError("the broker went away")
        super().send(topic, key, value, done)


class Forgetful(FolderClient):
    """Never tells what became of a message."""

    def send(self, topic, key, value, done):
        pass
