"""Errors of the engine. Bad data become rows with a reason first; these are for contracts that must hold whole."""


class EngineError(ValueError):
    """Any refusal of the engine."""


class InputError(EngineError):
    """A file or table hasn't the shape, columns or size that was asked for."""


class ContractError(EngineError):
    """Records of a batch break their contract; ``reasons`` counts them by reason."""

    def __init__(self, what: str, reasons: dict[str, int] | None = None):
        super().__init__(f"{what}: {reasons}" if reasons else what)
        self.reasons = reasons or {}


class SourceError(EngineError):
    """A page or its embedded state can't be read; the message is a code, never the page's content."""


class BudgetError(EngineError):
    """A run's limits are out of bounds, or used up."""


class InsufficientDataError(EngineError):
    """Too few rows, days or identities for a split or a model."""


class FeedError(EngineError):
    """A feed or model artifact isn't fit to be published."""
