"""DataFrame -> DataFrame operators of the surveillance pipeline."""
