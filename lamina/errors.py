"""Argument errors, raised on the driver before any job starts.

Failures of *rows* are never exceptions: they come back as result rows.
"""


class LaminaError(Exception):
    """Base class of every error this package raises."""


class InvalidParameterError(LaminaError):
    """An argument, or a combination of arguments, is not allowed."""


class LayerCapabilityError(LaminaError):
    """The layer's contract does not allow the requested operation."""


class MissingGeometryError(LaminaError):
    """Geometry was asked for, but the rows carry none or no CRS is known."""


class StaleLayerError(LaminaError):
    """A stored layer has moved on since the version an edit was made from."""
