"""Panel analytics on Spark: lazy DataFrame operators over keyed time series."""

from tidewheel.panel import Panel

__all__ = ["Panel"]
