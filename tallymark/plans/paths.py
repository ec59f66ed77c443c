"""Where a job's tables lie."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class JobPaths:
    """Names of a model's samples, conversions, results and model under a root folder."""

    root: str
    name: str
    sample_date: str
    predict_date: str | None = None
    version: str = "latest"
    model_name: str = "train_model"

    @property
    def folder(self) -> str:
        return f"{self.root}/model/{self.name}/{self.version}"

    def sample(self, kind: str) -> str:
        """kind: corpus, corpus_balance, applist, applist_balance, train or test."""
        return f"{self.folder}/sample/{kind}_{self.sample_date}.orc"

    @property
    def converted(self) -> str:
        return f"{self.root}/prepare/{self.version}/convert/{self.predict_date}.orc"

    @property
    def result(self) -> str:
        return f"{self.folder}/result/{self.predict_date}.orc"

    @property
    def model(self) -> str:
        return f"{self.folder}/model/{self.model_name}_{self.sample_date}"

    def on(self, predict_date: str) -> JobPaths:
        return replace(self, predict_date=predict_date)
