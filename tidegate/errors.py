"""Every refusal is an exception, so a failed step fails the job that ran it."""

from __future__ import annotations

from collections.abc import Sequence


class TidegateError(RuntimeError):
    """Base class of all refusals."""


class LandingError(TidegateError):
    """The landed pages are not a complete, well-formed, non-empty batch.

    ``missing`` are ranges of page numbers that are lacking, as far as they were looked for; an end of
    None means that nobody knows how many follow. ``attempt`` is the folder of a refused batch that
    was kept to be completed.
    """

    def __init__(
        self,
        message: str,
        missing: Sequence[tuple[int, int | None]] = (),
        attempt: str | None = None,
    ):
        super().__init__(message)
        self.missing = tuple(missing)
        self.attempt = attempt


class GateError(TidegateError):
    """A publish gate refused the snapshot; nothing was published."""


class ContractError(TidegateError):
    """A frame does not have the shape or the guarantees its contract promises."""
