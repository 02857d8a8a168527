"""Shallow forests out of a deep one.

Spark grows all trees of a forest level by level: every level is one group of
nodes (as long as their histograms fit ``maxMemoryInMB``), with features drawn in
the order of the nodes.  A fit with a smaller ``maxDepth`` and else the same
settings takes the same steps and only stops earlier, so its trees are those of
the deep fit, cut at that depth.
"""

from __future__ import annotations

from typing import Any

from pyspark import SparkContext
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.param import Param

# Nodes are JVM objects, up to millions in a forest: they are cut by one call there, compiled
# by Janino, which Spark itself needs.  A node at the new depth becomes a leaf with its own counts;
# two leaves with the same prediction become one, as where Spark ends a fit (``LearningNode.toNode``).
_JAVA = """
import org.apache.spark.ml.classification.*;
import org.apache.spark.ml.tree.*;

public class ForestCut {
    static Node cut(Node node, int depth) {
        if (node instanceof LeafNode) return node;
        InternalNode n = (InternalNode) node;
        if (depth == 0) return new LeafNode(n.prediction(), n.impurity(), n.impurityStats());
        Node l = cut(n.leftChild(), depth - 1);
        Node r = cut(n.rightChild(), depth - 1);
        if (l instanceof LeafNode && r instanceof LeafNode && l.prediction() == r.prediction())
            return new LeafNode(l.prediction(), n.impurity(), n.impurityStats());
        return new InternalNode(n.prediction(), n.impurity(), n.gain(), l, r, n.split(), n.impurityStats());
    }

    public static Object model(Object forest, Object depth) {
        RandomForestClassificationModel m = (RandomForestClassificationModel) forest;
        DecisionTreeClassificationModel[] trees = new DecisionTreeClassificationModel[m.trees().length];
        for (int i = 0; i < trees.length; i++) {
            DecisionTreeClassificationModel t = (DecisionTreeClassificationModel) m.trees()[i];
            trees[i] = new DecisionTreeClassificationModel(
                t.uid(), cut(t.rootNode(), ((Number) depth).intValue()), m.numFeatures(), m.numClasses());
        }
        return new RandomForestClassificationModel(m.uid(), trees, m.numFeatures(), m.numClasses());
    }
}
"""
_compiled: dict[str, Any] = {}


def _cut_method(sc: SparkContext):
    """The compiled method, once for each application."""
    if sc.applicationId not in _compiled:
        compiler = sc._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(sc._jvm.java.lang.Thread.currentThread().getContextClassLoader())
        compiler.cook(_JAVA)
        methods = compiler.getClassLoader().loadClass("ForestCut").getMethods()
        _compiled[sc.applicationId] = next(m for m in methods if m.getName() == "model")
    return _compiled[sc.applicationId]


def holds(est: Estimator, params: dict[Param, Any], deep: Model) -> bool:
    """Whether the fit of ``params`` takes the same steps as that of the forest ``deep``
    down to its depth: all nodes of its last level to be split are one group there."""
    if not isinstance(est, RandomForestClassifier):
        return False
    got = est.extractParamMap(params)
    depth = got[est.maxDepth]
    node = deep.numFeatures * got[est.maxBins] * (deep.numClasses + 1) * 8
    return depth <= deep.getOrDefault("maxDepth") and (
        got[est.numTrees] * 2 ** max(depth - 1, 0) * node <= got[est.maxMemoryInMB] * 2 ** 20)


def cut(est: Estimator, params: dict[Param, Any], deep: Model) -> Model:
    """The model ``est`` would fit with ``params``, which differ from those of ``deep`` in a smaller ``maxDepth``."""
    sc = SparkContext._active_spark_context
    args = sc._gateway.new_array(sc._jvm.java.lang.Object, 2)
    args[0], args[1] = deep._java_obj, est.extractParamMap(params)[est.maxDepth]
    model = est.copy(params)._copyValues(est._create_model(_cut_method(sc).invoke(None, args)))
    model._transfer_params_to_java()
    return model
