"""Run settings, read once on the driver and put into plans as literals."""

from __future__ import annotations

import os
import warnings
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any


class SettingError(ValueError):
    """A setting holds text that its type does not allow."""


@dataclass(frozen=True)
class RunConfig:
    """Settings of one run; the defaults are fixed values."""

    prompts_path: str = "prompts.json"
    output_dir: str = "./recordloom_output"
    model: str = "mistralai/Mixtral-8x7B-Instruct-v0.1"
    replicas: int = 1
    tensor_parallel_size: int = 1
    gpu_memory_utilization: float = 0.90
    dtype: str = "bfloat16"
    executor_backend: str = "ray"
    max_new_tokens: int = 512
    temperature: float = 0.5
    top_p: float = 1.0
    top_k: int = -1
    max_model_len: int | None = None
    batch_size: int = 16
    job_id: str = "localrun"
    trust_remote_code: bool = False
    setting_warnings: tuple[str, ...] = field(default=())

    def with_(self, **changes: Any) -> RunConfig:
        return replace(self, **changes)

    def backend_options(self) -> dict[str, Any]:
        """Model settings handed to the backend factory as they are."""
        # Argument names and the values that are no setting.
        options = {
            "model": self.model,
            "dtype": self.dtype,
            "tensor_parallel_size": self.tensor_parallel_size,
            "gpu_memory_utilization": self.gpu_memory_utilization,
            "distributed_executor_backend": self.executor_backend,
            "guided_decoding_backend": "xgrammar",
            "trust_remote_code": self.trust_remote_code,
            "enforce_eager": True,
        }
        if self.max_model_len:
            options["max_model_len"] = self.max_model_len
        return options


# Environment variable of each setting.
ENVIRONMENT_NAMES = {
    "prompts_path": "PROMPTS_FILE_ENV",
    "output_dir": "OUTPUT_DIR_ENV",
    "model": "MODEL_ID_OR_PATH_ENV",
    "replicas": "PIPELINE_PARALLEL_SIZE_ENV",
    "tensor_parallel_size": "TENSOR_PARALLEL_SIZE_ENV",
    "gpu_memory_utilization": "GPU_MEMORY_UTILIZATION_ENV",
    "dtype": "MODEL_DTYPE_ENV",
    "executor_backend": "VLLM_DISTRIBUTED_EXECUTOR_BACKEND",
    "max_new_tokens": "MAX_NEW_TOKENS",
    "temperature": "TEMPERATURE",
    "top_p": "TOP_P",
    "top_k": "TOP_K",
    "batch_size": "RAY_DATA_BATCH_SIZE",
    "job_id": "SLURM_JOB_ID",
    "trust_remote_code": "TRUST_REMOTE_CODE_ENV",
}
MAX_MODEL_LEN_NAME = "MAX_MODEL_LEN_ENV"


def _flag(text: str) -> bool:
    known = {"true": True, "1": True, "false": False, "0": False, "": False}
    if text.strip().lower() not in known:
        raise ValueError(text)
    return known[text.strip().lower()]


def from_env(env: Mapping[str, str] | None = None) -> RunConfig:
    """Settings from a mapping of names to text (the process environment by default).

    Bad text in a typed setting raises :class:`SettingError` naming the setting.  The
    maximum model length is tolerant instead: bad text leaves it unset and warns, and
    empty text or 0 mean unset.
    """
    env = os.environ if env is None else env
    defaults = RunConfig()
    values: dict[str, Any] = {}
    for name, variable in ENVIRONMENT_NAMES.items():
        if variable not in env:
            continue
        wanted: Callable[[str], Any] = type(getattr(defaults, name))
        if wanted is bool:
            wanted = _flag
        try:
            values[name] = wanted(env[variable])
        except ValueError as problem:
            raise SettingError(
                f"{variable}={env[variable]!r} is not a valid {wanted.__name__.strip('_')}"
            ) from problem
    length = env.get(MAX_MODEL_LEN_NAME, "")
    if length:
        try:
            values["max_model_len"] = int(length) or None
        except ValueError:
            text = f"{MAX_MODEL_LEN_NAME}={length!r} is not an integer; left unset"
            warnings.warn(text, stacklevel=2)
            values["setting_warnings"] = (text,)
    return replace(defaults, **values)
