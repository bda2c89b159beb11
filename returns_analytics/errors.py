"""Errors a run can stop with."""


class RunError(Exception):
    """Base class: the run cannot give a right result and stops."""


class InvalidPeriod(RunError):
    """A period parameter is not MMYYYY."""


class MissingTable(RunError):
    """A required input is absent or holds nothing for the period."""


class DueDateError(RunError):
    """No active due date, or more than one, for a period."""


class DuplicateKeys(RunError):
    """Rows that must be unique by key are not."""


class GateFailed(RunError):
    """A data-quality gate stopped the run."""


class PublishConflict(RunError):
    """Another run published the same period while this one was writing it."""
