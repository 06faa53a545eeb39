"""Jobs made of the operators: training, search and batch scoring."""
