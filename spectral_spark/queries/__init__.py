"""Every query of the library, each on the driver's tables."""

from ..registry import ORACLES, QUERIES
from . import filters, joins, kernels, scalars, sources, spectra, stack, windows

__all__ = ["ORACLES", "QUERIES", "filters", "joins", "kernels", "scalars", "sources", "spectra", "stack", "windows"]
