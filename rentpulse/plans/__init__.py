"""The rental tables, each a named DataFrame function over the operators."""
