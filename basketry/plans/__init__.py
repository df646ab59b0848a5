"""The layers as functions from DataFrame to DataFrame, for batches and streams alike."""
