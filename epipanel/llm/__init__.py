"""Training-data operators over documents, labels and conversations."""
