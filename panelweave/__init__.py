"""Panel analytics on Spark: plain functions from DataFrame to DataFrame."""

from panelweave.spec import PanelSpec

__all__ = ["PanelSpec"]
