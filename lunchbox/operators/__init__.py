"""DataFrame -> DataFrame operators over :class:`lunchbox.sources.model.HRModel`."""
