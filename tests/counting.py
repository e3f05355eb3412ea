"""Models whose calls can be counted from outside their tasks: every call leaves a file."""

from __future__ import annotations

import os
import uuid

from lectern.operators.inference import EchoModel


class CountingModel:
    def __init__(self, folder: str, model=None) -> None:
        self.folder, self.model = folder, model or EchoModel(flaky_every=0)
        os.makedirs(folder, exist_ok=True)

    def __call__(self, prompt: str) -> str:
        with open(os.path.join(self.folder, uuid.uuid4().hex), "w"):
            pass
        return self.model(prompt)

    def calls(self) -> int:
        return len(os.listdir(self.folder))


class Died(BaseException):
    pass


class DyingModel(CountingModel):
    """Takes its task down after so many calls in all."""

    def __init__(self, folder: str, after: int) -> None:
        super().__init__(folder)
        self.after = after

    def __call__(self, prompt: str) -> str:
        if self.calls() >= self.after:
            raise Died("died")
        return super().__call__(prompt)
