"""The staged views of the catalog and the batch run that chains them."""
