"""The four subject areas as configuration over the operators."""
