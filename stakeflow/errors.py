"""One error type for all input-contract failures."""


class DataValidationError(ValueError):
    """Raised when an input table breaks a contract (empty, missing column...)."""


class ArtifactError(RuntimeError):
    """Raised when a written model bundle is incomplete or inconsistent."""
